"""Sinks and sources of the job.

Paths are plain Hadoop paths; on a cluster they must be shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.clean import clean

RUN_SCHEMA = ("roc_auc DOUBLE, precision DOUBLE, recall DOUBLE, f1_score DOUBLE, accuracy DOUBLE, "
              "threshold DOUBLE, fraud_rate DOUBLE, training_time_seconds DOUBLE, feature_count BIGINT, "
              "combination_name STRING, _timestamp DOUBLE")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FileSystem API (works for any shared store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def write_cleaned(df: DataFrame, path: str) -> None:
    """A3: cleaned table, partitioned by calendar day so time filters prune files."""
    out = df.withColumn("transaction_day", F.to_date("transaction_date")) if "transaction_date" in df.columns else df
    writer = out.write.mode("overwrite")
    if "transaction_day" in out.columns:
        writer = writer.partitionBy("transaction_day")
    writer.parquet(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop("transaction_day") if "transaction_day" in df.columns else df


def build_or_reuse(spark: SparkSession, cleaned_path: str, raw: DataFrame | None) -> DataFrame:
    """Read the cleaned table if present, else clean ``raw``, save and read it back."""
    if path_exists(spark, cleaned_path):
        return read_cleaned(spark, cleaned_path)
    if raw is None:
        raise FileNotFoundError(f"neither {cleaned_path} nor a raw table is available")
    write_cleaned(clean(raw), cleaned_path)
    return read_cleaned(spark, cleaned_path)


def write_features_and_labels(features: DataFrame, path: str, label: str = "is_fraudulent",
                              key: str = "row_id") -> None:
    """A4: features without the target, labels ``(row_id, is_fraudulent)`` - both keyed by row id."""
    features.drop(label).write.mode("overwrite").parquet(f"{path}/features")
    features.select(key, label).write.mode("overwrite").parquet(f"{path}/labels")


def write_predictions(scored: DataFrame, path: str) -> None:
    """A5: features + ``anomaly_score`` + ``predicted_fraud``."""
    scored.write.mode("overwrite").parquet(path)


def labels_with_fallback(spark: SparkSession, candidates: Sequence[tuple[str, str]],
                         key: str = "row_id") -> DataFrame | None:
    """First existing ``(path, label column)`` gives ``(row_id, is_fraudulent)``; else ``None``."""
    for path, col in candidates:
        if path_exists(spark, path):
            df = spark.read.parquet(path)
            if col in df.columns and key in df.columns:
                return df.select(key, F.col(col).cast("int").alias("is_fraudulent"))
    return None


def read_run_records(spark: SparkSession, glob: str) -> DataFrame:
    """Run-summary JSON with a declared, all-nullable schema, tagged with the file it came from."""
    return spark.read.schema(RUN_SCHEMA).json(glob).withColumn("run_file", F.input_file_name())
