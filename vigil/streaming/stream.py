"""Structured Streaming (2.S): the event table as a file stream.

* S1 ``score_stream``: stateless scoring with fitted parameters (``batch_stats="fitted"``)
  and the stored threshold - the same projection as the batch path.
* S2 ``window_alerts``: tumbling event-time windows with a watermark.
* S3 ``sliding_velocity``: per-customer sliding-window counts.

Runs use ``trigger(availableNow=True)``; output and the query's checkpoint live
in the shared checkpoint folder, so a restarted query resumes exactly once.
Windows run in update mode: every micro-batch writes the windows it has changed
into a folder of its own, which a repeated batch overwrites, and a reader takes
the last state of each window. So windows that the watermark has not passed
when the stream ends are there as well, and none is written twice.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import ensure_checkpoint_dir

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", files_per_trigger).parquet(sf_dir))


def event_time(col: str = "ts") -> F.Column:
    """Zone-free timestamp -> instant read as UTC wall clock (``withWatermark`` needs TIMESTAMP)."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})"))


def run_to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame to completion into Parquet under the checkpoint folder; read it back."""
    spark = df.sparkSession
    root = os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex}")
    out, chk = os.path.join(root, "out"), os.path.join(root, "chk")
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", chk)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(out)


def run_windows(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Run an aggregating stream over what is there now, into ``path`` (or go on with a run that wrote there); all
    windows so far, one row per ``keys``."""
    spark = df.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")

    q = (df.writeStream.outputMode("update").option("checkpointLocation", f"{path}/chk")
         .trigger(availableNow=True).foreachBatch(merge).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).option("basePath", f"{path}/out").parquet(f"{path}/out")
    values = [c for c in df.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("last"))
    return last.select(*[F.col(f"last.{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def windows_path(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex}")


def window_alerts(events: DataFrame, threshold: float, window: str = "1 day",
                  delay: str = "1 hour") -> DataFrame:
    """Per tumbling window: events, alerts (value > threshold) and alerted amount."""
    ev = events.withColumn("event_time", event_time("ts")).withWatermark("event_time", delay)
    alert = F.col("value") > F.lit(threshold)
    g = ev.groupBy(F.window("event_time", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(alert.cast("long")).alias("n_alerts"),
        F.sum(F.when(alert, F.col("value")).otherwise(0.0)).alias("alert_amount"))
    return g.select(F.unix_micros(F.col("w.start")).alias("window_start_us"),
                    F.unix_micros(F.col("w.end")).alias("window_end_us"), "n_events", "n_alerts", "alert_amount")


def sliding_velocity(events: DataFrame, length: str = "1 hour", slide: str = "10 minutes",
                     delay: str = "1 hour") -> DataFrame:
    """S3: events per customer in sliding windows."""
    ev = events.withColumn("event_time", event_time("ts")).withWatermark("event_time", delay)
    g = ev.groupBy("user_id", F.window("event_time", length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
    return g.select("user_id", F.unix_micros(F.col("w.start")).alias("window_start_us"), "n_events",
                    "total_value")
