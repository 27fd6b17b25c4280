"""Means and comoments of many columns in one scan.

Each partition reduces its rows to one (count, mean, comoment matrix) per group,
batch by batch in Arrow; partial results are merged pairwise (Chan, Golub and
LeVeque, 1979), which stays exact to rounding where sums of squares cancel. What
moves is a d x d matrix per partition, merged in ``BUCKETS`` tasks, so that at most
that many per group reach the driver. Scaler, covariance and standardised covariance
all follow from the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 64
PARTIAL = "g int, n long, mean binary, comoment binary"


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    comoment: np.ndarray  # sum of (x - mean)(x - mean)'

    @staticmethod
    def of(x: np.ndarray) -> "Moments":
        mean = x.mean(axis=0)
        return Moments(len(x), mean, (x - mean).T @ (x - mean))

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.comoment + other.comoment + np.outer(gap, gap) * (self.n * other.n / n))

    def std(self) -> np.ndarray:
        """Population standard deviations."""
        return np.sqrt(np.maximum(np.diag(self.comoment), 0.0) / self.n)


def _batch(found: dict[int, Moments]) -> Iterator[pa.RecordBatch]:
    if found:
        g, m = zip(*sorted(found.items()))
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array([x.n for x in m], pa.int64()), pa.array([x.mean.tobytes() for x in m], pa.binary()),
                                          pa.array([x.comoment.tobytes() for x in m], pa.binary())], ["g", "n", "mean", "comoment"])


def _read(n: int, mean: bytes, comoment: bytes) -> Moments:
    m = np.frombuffer(mean)
    return Moments(n, m, np.frombuffer(comoment).reshape(len(m), len(m)))


def moments(df: DataFrame, features: Sequence[str], group: Column | None = None) -> dict[int, Moments]:
    """``Moments`` of the features by the small integer ``group`` (null is group -1); nulls count as 0."""
    features = list(features)
    g = F.coalesce((group if group is not None else F.lit(0)).cast("int"), F.lit(-1))
    rows = df.select(g.alias("_g"), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_{i}") for i, f in enumerate(features)])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            if batch.num_rows:
                groups = batch.column(0).to_numpy()
                x = np.column_stack([c.to_numpy() for c in batch.columns[1:]])
                for k in np.unique(groups).tolist():
                    part = Moments.of(x[groups == k])
                    found[k] = found[k] + part if k in found else part
        yield from _batch(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                k, *rest = (c[r].as_py() for c in batch.columns)
                part = _read(*rest)
                found[k] = found[k] + part if k in found else part
        yield from _batch(found)

    partial = rows.mapInArrow(reduce, PARTIAL).repartition(BUCKETS).mapInArrow(merge, PARTIAL)
    out: dict[int, Moments] = {}
    for r in sorted(partial.collect(), key=lambda r: (r.g, r.n, bytes(r["mean"]))):  # BUCKETS rows a group at most
        part = _read(r.n, bytes(r["mean"]), bytes(r["comoment"]))
        out[r.g] = out[r.g] + part if r.g in out else part
    return out
