"""Standardisation (L1-L3): population mean / std of each feature on the fit
rows in one aggregate; zero spread becomes 1; columns are aligned by name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.quality import wide_stats


@dataclass
class FittedScaler:
    features: list[str]
    mean: dict[str, float]
    std: dict[str, float]

    def transform(self, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> DataFrame:
        """L2 + L3: missing features enter as 0.0, extra columns are dropped."""
        cols = []
        for f in self.features:
            x = F.col(f).cast("double") if f in df.columns else F.lit(0.0)
            cols.append(((x - F.lit(self.mean[f])) / F.lit(self.std[f])).alias(f))
        return df.select(*[k for k in keep if k in df.columns], *cols)


def fit_scaler(df: DataFrame, features: Sequence[str]) -> FittedScaler:
    r = {x.feature: x for x in wide_stats(df, features, {"m": F.avg, "s": F.stddev_pop}).collect()} if features else {}
    mean = {f: r[f].m or 0.0 for f in features}
    std = {f: r[f].s or 1.0 for f in features}
    return FittedScaler(list(features), mean, std)
