"""Exact checksums of many features: blocks of rows in numpy, a state per feature, group and task.

The total is that of the values rounded half up to 6 places, as decimals. A value's millionths are a whole number, and
whole numbers add up exactly in any order, so no value becomes a decimal: only those of 10**8 and more with a fraction,
whose digits a double does not settle, are rounded as text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint, settings

PLACES = 6
UNITS = 10 ** PLACES
SETTLED = 1e8                 # below it 15 digits hold a value to 7 places, as many as every double keeps apart
WHOLE = float(1 << 53)        # whole numbers below it are exact
TOTAL = T.DecimalType(38, PLACES)
STATE = T.StructType([T.StructField("total", TOTAL), T.StructField("n_nonzero", T.LongType()),
                      T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])
#: rows are of fixed width, so their number bounds a batch; a limit in bytes is tested by adding up all columns after each row
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": str((1 << 31) - 1)}
SMALL = (T.ByteType, T.ShortType, T.IntegerType)  # sent as they are, the others as doubles

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the code


def whole_sum(k: np.ndarray) -> int:
    """Sum of integers below 2**62 that may not fit 64 bits."""
    return (int((k >> 31).sum()) << 31) + int((k & ((1 << 31) - 1)).sum())


def _as_text(x: float) -> int:
    digits = Context(prec=400)
    for _ in range(2):  # rounded, kept as a double and read to 6 places
        x = float(d := Decimal(repr(x)).quantize(Decimal(1).scaleb(-PLACES), ROUND_HALF_UP, digits))
    return int(d.scaleb(PLACES, digits))


def units(x: np.ndarray) -> int:
    """Millionths in all doubles ``x``, each rounded half up by its shortest decimal digits."""
    a = np.abs(x)
    if not (top := a.max(initial=0.0)) < SETTLED:
        if not np.isfinite(top):
            raise ValueError("no decimal total of NaN or infinite values")
        large = a >= SETTLED
        rest, x, a = x[large], x[~large], a[~large]
        whole = (np.abs(rest) < WHOLE) & (rest == np.rint(rest))
        more = UNITS * whole_sum(rest[whole].astype(np.int64)) + sum(map(_as_text, rest[~whole].tolist()))
    else:
        more = 0
    n = np.floor(a * UNITS)
    # the double nearest to n and a half millionths, exactly: 10 n + 5 is whole and below 2**53; digits of 15 places tie with it only
    n += a >= (10 * n + 5) / (10 * UNITS)
    return whole_sum(np.copysign(n, x).astype(np.int64)) + more


class Checksum:
    """Of the values of a feature and group so far."""

    def __init__(self) -> None:
        self.seen, self.total, self.n_nonzero, self.low, self.high = False, None, 0, 0.0, 0.0

    def add(self, x: np.ndarray) -> None:
        if not len(x):
            return
        low, high = float(x.min()), float(x.max())
        numbers = x
        if low != low:  # NaN is above all numbers, is not zero and has no decimal
            low, numbers = float(np.fmin.reduce(x)), x[~np.isnan(x)]
        self.low, self.high = (float(np.fmin(self.low, low)), float(np.maximum(self.high, high))) if self.seen else (low, high)
        self.seen = True
        self.n_nonzero += int(np.count_nonzero(x))
        if len(numbers):
            more = UNITS * int(numbers.sum(dtype=np.int64)) if x.dtype.kind == "i" else units(numbers)
            self.total = (self.total or 0) + more

    def state(self) -> dict | None:
        if not self.seen:
            return dict.fromkeys(STATE.names)
        total = None if self.total is None else Decimal(self.total).scaleb(-PLACES, Context(prec=400))
        return {"total": total, "n_nonzero": self.n_nonzero, "low": self.low, "high": self.high}


def _parts(keys: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray | None]]:
    """The groups of a batch, and which rows are theirs (None: all)."""
    codes = np.zeros(keys.num_rows, np.int64)
    for c in keys.columns:
        d = c.dictionary_encode("encode")
        codes = np.unique(codes * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    _, first = np.unique(codes, return_index=True)
    for at in first.tolist():
        yield tuple(c[at].as_py() for c in keys.columns), None if len(first) == 1 else codes == codes[at]


def checksum_states(df: DataFrame, features: Sequence[str], by: Sequence[str], using: Sequence[str] = ()) -> DataFrame:
    """``by``, ``_i`` (place of the feature) and ``_x``, the STATE of its values that are not null: a row per feature, group and task."""
    if using:
        raise ValueError("checksums read no other columns")
    kinds = [df.schema[f].dataType for f in features]
    values = [F.col(f) if isinstance(k, SMALL) else F.col(f).cast("double") for f, k in zip(features, kinds)]
    rows = df.select(*by, *[x.alias(f"_f{i}") for i, x in enumerate(values)])
    n = len(by)
    out = T.StructType([*rows.schema.fields[:n], T.StructField("_i", T.IntegerType()), T.StructField("_x", STATE)])
    state = pa.struct([("total", pa.decimal128(38, PLACES)), ("n_nonzero", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[Checksum]] = {}
        kinds = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [f.type for f in batch.schema][:n]
            for key, mine in _parts(batch.select(range(n))):
                sums = found.setdefault(key, [Checksum() for _ in features])
                for c, s in zip(batch.columns[n:], sums):
                    if c.null_count:
                        s.add((c if mine is None else c.filter(pa.array(mine))).drop_null().to_numpy())
                    else:
                        s.add(c.to_numpy() if mine is None else c.to_numpy()[mine])
        for key, sums in found.items():
            keys = [pa.array([v] * len(sums), k) for v, k in zip(key, kinds)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(range(len(sums)), pa.int32()), pa.array([s.state() for s in sums], state)], out.names)

    with settings(df.sparkSession, BATCHES):
        return checkpoint(rows.mapInArrow(reduce, out))


#: of a state column: exact order-free total, non-zero count, min, max
CHECKSUMS = {
    "total": lambda x: F.sum(x["total"]).cast("double"),
    "n_nonzero": lambda x: F.sum(x["n_nonzero"]),
    "min_value": lambda x: F.round(F.min(x["low"]), PLACES),
    "max_value": lambda x: F.round(F.max(x["high"]), PLACES)}
