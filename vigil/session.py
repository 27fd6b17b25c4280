"""Session construction and the checkpoint folder.

Library code never picks a machine-local folder on a cluster: the
checkpoint directory is read from the session (``spark.checkpoint.dir`` or
an already configured SparkContext directory). Only a ``local[...]`` master
without any setting gets a fresh scratch folder, which is what tests and
the benchmark use.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "vigil", driver_memory: str = "8g") -> SparkSession:
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.maxFields", "256")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it from the session."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    scratch = tempfile.mkdtemp(prefix="vigil-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def checkpoint(df):
    """Reliable, eager checkpoint (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: the files of a job's shuffles go when it ends, not when the driver happens to collect its garbage
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(parts: Iterable[Callable[[], DataFrame]]) -> tuple[DataFrame, Callable[[], None]]:
    """The rows of all ``parts`` as one Parquet table in the checkpoint folder, and what removes it.

    Unlike ``checkpoint`` columns are compressed and read one by one. A part is made and written, and its shuffle files go,
    before the next one is."""
    path = schema = spark = None
    for make in parts:
        df = make()
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
        with settings(spark, FREE_SHUFFLES):
            df.write.mode("append").option("compression", "zstd").parquet(path)

    def remove() -> None:
        sc = spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)

    return spark.read.schema(schema).parquet(path), remove


# Runtime SQL settings for the wide feature plans (about 100 derived columns):
# constraint propagation enumerates implied predicates over every aliased
# expression and exhausts the driver heap on such plans, and whole-stage codegen
# switches off above ``maxFields`` output columns.
WIDE_PLAN_CONF = {
    # zone-free timestamps are converted through the session zone in a few
    # expressions; UTC keeps wall-clock arithmetic free of DST shifts
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.codegen.maxFields": "256",
    # the JVM never compiles a method above 8000 bytes of bytecode, and one method that makes all derived columns is
    # far above: such a plan runs as projections of many small methods instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
#: the same for the text operators, whose plans are not wide: the limit is Spark's own
TEXT_PLAN_CONF = WIDE_PLAN_CONF | {"spark.sql.codegen.hugeMethodLimit": "65535"}


def apply_wide_plan_conf(spark: SparkSession, settings: dict = WIDE_PLAN_CONF) -> None:
    for k, v in settings.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict) -> Iterator[None]:
    """Runtime SQL settings for the jobs started within; the session's own come back after them."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        apply_wide_plan_conf(spark, values)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
