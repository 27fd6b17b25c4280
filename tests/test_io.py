"""Sources and sinks."""

import json

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.sources import io
from vigil.sources.fixtures import card


def test_build_or_reuse_writes_once_then_reads(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    raw = card(spark, SF_SMALL)
    first = io.build_or_reuse(spark, path, raw)
    assert io.path_exists(spark, path)
    again = io.build_or_reuse(spark, path, None)          # no raw needed the second time
    assert first.count() == again.count() == raw.count()
    assert "transaction_day" not in again.columns and "transaction_date" in again.columns


def test_label_fallback_order(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, class int")
    p2 = str(tmp_path / "second")
    labels.write.parquet(p2)
    got = io.labels_with_fallback(spark, [(str(tmp_path / "missing"), "is_fraudulent"), (p2, "class")])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0), (2, 1)]
    assert io.labels_with_fallback(spark, [(str(tmp_path / "missing"), "x")]) is None


def test_features_and_labels_sink_keyed_by_row_id(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 1.5, 1)], "row_id long, f double, is_fraudulent int")
    io.write_features_and_labels(df, str(tmp_path / "out"))
    feats = spark.read.parquet(str(tmp_path / "out/features"))
    labs = spark.read.parquet(str(tmp_path / "out/labels"))
    assert "is_fraudulent" not in feats.columns
    assert feats.join(labs, "row_id").count() == 2


def test_run_records_nullable_schema(spark, tmp_path):
    d = tmp_path / "runs"
    d.mkdir()
    (d / "a.json").write_text(json.dumps({"roc_auc": 0.7, "combination_name": "a", "feature_count": 39}))
    (d / "b.json").write_text(json.dumps({"roc_auc": 0.74, "combination_name": "b"}))
    runs = io.read_run_records(spark, str(d / "*.json"))
    best = runs.agg(F.max_by("combination_name", "roc_auc")).first()[0]
    assert best == "b" and runs.where(F.col("feature_count").isNull()).count() == 1
