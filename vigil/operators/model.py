"""The fitted anomaly model as one estimator: cleaning statistics, features, scaler,
linear reconstruction and threshold, fitted together, saved as tables and applied in
any other session, to batches and to streams.

The fit scans the feature table once for the moments of both classes (scaler and
components follow from them) and once for the scores that the threshold is taken
from; neither wide table is kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.clean import clean
from vigil.operators.evaluate import predict
from vigil.operators.features import TARGET, FeatureModel, FittedFeatures, UnfittedError
from vigil.operators.linear_ae import LinearAutoencoder
from vigil.operators.moments import moments
from vigil.operators.scale import FittedScaler
from vigil.operators.select import exact_quantiles
from vigil.session import checkpoint

SCORE = "anomaly_score"
PART_SCHEMA = "position int, feature string, mean double, std double, centre double, loadings array<double>"


@dataclass
class AnomalyModel:
    features: FittedFeatures
    scaler: FittedScaler
    linear: LinearAutoencoder        # over standardised features
    percentile: float
    clean_params: dict = field(default_factory=dict)

    @staticmethod
    def fit(train: DataFrame, latent_dim: int = 16, percentile: float = 95, clean_params: dict | None = None, **options) -> "AnomalyModel":
        """Fit on the cleaned ``train`` rows: scaler on all, reconstruction and threshold on the normal ones.

        A null label counts as normal. ``options`` are those of ``FeatureModel``."""
        fitted = FeatureModel(**options).fit(train)
        table = fitted.transform(train, keep=("row_id", TARGET))
        names = [c for c in table.columns if c not in ("row_id", TARGET)]
        by_label = moments(table, names, (F.coalesce(F.col(TARGET), F.lit(0)) != 0).cast("int"))
        if 0 not in by_label:
            raise UnfittedError("no normal rows to fit on")
        everything = by_label[0] + by_label[1] if 1 in by_label else by_label[0]
        std = everything.std()
        std[~(std > 0)] = 1.0
        normal = by_label[0]
        centre = (normal.mean - everything.mean) / std
        values, vectors = np.linalg.eigh(normal.comoment / normal.n / np.outer(std, std))
        components = vectors[:, np.argsort(-values, kind="stable")[: min(latent_dim, len(names))]]
        components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])
        scaler = FittedScaler(names, dict(zip(names, everything.mean.tolist())), dict(zip(names, std.tolist())))
        model = AnomalyModel(fitted, scaler, LinearAutoencoder(names, centre, components), percentile, clean_params or {})
        scores = checkpoint(model._scored(table.where(F.coalesce(F.col(TARGET), F.lit(0)) == 0), ()))
        model.linear.threshold = exact_quantiles(scores, [SCORE], [percentile / 100.0])[()][SCORE][0]
        return model

    def _scored(self, table: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the mean squared reconstruction error of the rows of a feature table. Features that the
        table lacks enter as 0, others are not read."""
        names = self.scaler.features
        mean, std = (np.array([d[f] for f in names]) for d in (self.scaler.mean, self.scaler.std))
        centre, components = self.linear.mean, self.linear.components
        keep = [c for c in keep if c in table.columns]
        source = table.select(*keep, *[(F.col(f).cast("double") if f in table.columns else F.lit(0.0)).alias(f"_{i}") for i, f in enumerate(names)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([c.fill_null(0.0).to_numpy() for c in batch.columns[len(keep):]]) if batch.num_rows else np.zeros((0, len(names)))
                x = (x - mean) / std - centre
                error = ((x - (x @ components) @ components.T) ** 2).mean(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(error)], [*keep, SCORE])

        return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in keep), T.StructField(SCORE, T.DoubleType())]))

    def clean(self, raw: DataFrame) -> DataFrame:
        """A raw table cleaned with the statistics of the fit (batch or stream)."""
        return clean(raw, self.clean_params or None)

    def score(self, rows: DataFrame, keep: Sequence[str] = ("row_id", TARGET), batch_col: str | None = None) -> DataFrame:
        """``keep`` and the anomaly score of cleaned rows; ``batch_col`` names what batch statistics are taken by."""
        return self._scored(self.features.transform(rows, batch_col, tuple(keep)), keep)

    def predict(self, rows: DataFrame, keep: Sequence[str] = ("row_id", TARGET), batch_col: str | None = None) -> DataFrame:
        """``score`` with ``predicted_fraud``: 1 where the score is above the threshold."""
        return predict(self.score(rows, keep, batch_col), SCORE, self.linear.threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        """Tables below ``path``, which other sessions must reach; written anew as a whole. ``model`` is written last,
        so a folder without it is an unfinished save."""
        self.features.save(spark, f"{path}/features")
        names = self.scaler.features
        rows = [(i, f, self.scaler.mean[f], self.scaler.std[f], float(self.linear.mean[i]), self.linear.components[i].tolist()) for i, f in enumerate(names)]
        spark.createDataFrame(rows, PART_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
        spark.createDataFrame([(self.linear.threshold, float(self.percentile), json.dumps(self.clean_params))],
                              "threshold double, percentile double, clean string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "AnomalyModel":
        from vigil.sources.io import path_exists
        if not path_exists(spark, f"{path}/model/_SUCCESS"):
            raise UnfittedError(f"no fitted model at {path}")
        head = spark.read.parquet(f"{path}/model").first()
        parts = spark.read.schema(PART_SCHEMA).parquet(f"{path}/parts").orderBy("position").collect()  # a row per feature
        names = [r.feature for r in parts]
        linear = LinearAutoencoder(names, np.array([r.centre for r in parts]), np.array([r.loadings for r in parts]), head.threshold)
        scaler = FittedScaler(names, {r.feature: r["mean"] for r in parts}, {r.feature: r["std"] for r in parts})
        return AnomalyModel(FittedFeatures.load(spark, f"{path}/features"), scaler, linear, head.percentile, json.loads(head["clean"]))
