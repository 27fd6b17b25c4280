"""Linear reconstruction model.

The MSE-optimal linear autoencoder with ``latent_dim`` units spans the top
principal components of the centred fit rows (Baldi & Hornik, 1989); they come
from the moments of one scan (``vigil.operators.model``), so only the d x k loading
matrix is kept. Scoring is an Arrow-batched pass with the loadings in the closure:
one matrix product per batch, no per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class LinearAutoencoder:
    features: list[str]
    mean: np.ndarray
    components: np.ndarray          # d x k
    threshold: float | None = None

    def score(self, df: DataFrame, keep: Sequence[str] = ("row_id",), name: str = "anomaly_score") -> DataFrame:
        """L7 + L8: mean squared reconstruction error per row."""
        feats, mean, comp = list(self.features), self.mean, self.components
        keep = [k for k in keep if k in df.columns]
        src = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in feats])
        schema = T.StructType([src.schema[k] for k in keep] + [T.StructField(name, T.DoubleType())])

        def run(batches):
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype="float64") - mean
                recon = (x @ comp) @ comp.T
                err = ((x - recon) ** 2).mean(axis=1)
                out = pdf[keep].copy()
                out[name] = err
                yield out

        return src.mapInPandas(run, schema)

    def importance(self) -> list[tuple[str, float]]:
        """Mean |loading| per input feature, sorted descending."""
        imp = np.abs(self.components).mean(axis=1)
        return sorted(zip(self.features, imp.tolist()), key=lambda t: (-t[1], t[0]))

    def n_params(self) -> int:
        """Parameters of the tied linear encoder/decoder (weights + biases)."""
        d, k = self.components.shape
        return d * k * 2 + k + d
