"""Data-quality and leakage checks (O1-O16), each a query over split tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.rank import descents

NEAR_CONSTANT_STD = 1e-10
EXTREME_ABS = 1e6
STABILITY_SHIFT = 0.5
# fixed values: share of stable features and bounds of the fraud rate that the checks ask for
STABLE_SHARE = 0.8
RATE_BOUNDS = (0.0001, 0.01)


def long_form(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features
    ])).alias("kv")).select(*keys, "kv.feature", "kv.value")


def wide_stats(df: DataFrame, features: Sequence[str], stats: dict, by: Sequence[str] = (), using: Sequence[str] = (),
               states: Callable | None = None) -> DataFrame:
    """Per-feature statistics in ONE aggregate over the features of a row, stacked: code and state are those of one
    feature, however many there are, and map-side combine leaves a row per feature, group and task.

    ``stats`` maps output name -> function(Column) -> aggregate Column, which may read the columns ``using``, too.
    ``states`` (as ``checksum_states``) sums the values up by blocks before; the stats then aggregate its states.
    Without ``by``, every feature has a row, also of an empty table.
    """
    if states is None:
        x = F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("_i", "_x")
        stacked = df.select(*dict.fromkeys([*by, *using]), x)
    else:
        stacked = states(df, features, by, using)
    found = stacked.groupBy(*by, "_i").agg(*[fn(F.col("_x")).alias(n) for n, fn in stats.items()])
    if not by:
        found = df.sparkSession.range(len(features), numPartitions=1).select(F.col("id").cast("int").alias("_i")).join(found, "_i", "left")
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_i") + 1)
    return found.select(*by, name.alias("feature"), *stats)


def temporal_order(df: DataFrame, ts: str = "transaction_date", split: str = "split") -> DataFrame:
    """O1: every test time is after every train time."""
    a = df.agg(F.max(F.when(F.col(split) == "train", F.col(ts))).alias("max_train"),
               F.min(F.when(F.col(split) == "test", F.col(ts))).alias("min_test"))
    return a.withColumn("ordered", F.col("min_test") > F.col("max_train"))


def overlap(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` present on both sides."""
    l_ = left.select(col).distinct()
    return l_.join(right.select(col).distinct(), col, "left_semi").agg(F.count(F.lit(1)).alias("n_overlap"))


def id_overlap(df: DataFrame, split: str = "split") -> DataFrame:
    """Every column whose name contains ``id``: train and test share values => leak."""
    ids = [c for c in df.columns if "id" in c.lower() and c != split]
    train, test = df.where(F.col(split) == "train"), df.where(F.col(split) == "test")
    parts = [overlap(train, test, c).select(F.lit(c).alias("column"), "n_overlap") for c in ids]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("leak", F.col("n_overlap") > 0)


def stability(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """Relative mean shift < 0.5 per feature (|test mean| < 1 when the train mean is 0)."""
    is_train, is_test = F.col(split) == "train", F.col(split) == "test"
    m = wide_stats(df, features, {"train_mean": lambda x: F.avg(F.when(is_train, x)),
                                  "test_mean": lambda x: F.avg(F.when(is_test, x))}, using=[split])
    ok = F.when(F.col("train_mean") == 0, F.abs(F.col("test_mean")) < 1).otherwise(
        F.abs(F.col("test_mean") - F.col("train_mean")) / F.abs(F.col("train_mean")) < STABILITY_SHIFT)
    return m.withColumn("stable", F.coalesce(ok, F.lit(False)))


def stability_verdict(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """How many of the features are stable, and whether more than 80 % are (no features: not)."""
    a = stability(df, features, split).agg(F.count(F.lit(1)).alias("n_features"), F.count_if("stable").alias("n_stable"))
    return a.withColumn("stable", F.col("n_stable") > F.lit(STABLE_SHARE) * F.col("n_features"))


def target_absent(features: DataFrame, label: str = "is_fraudulent") -> DataFrame:
    """Per column of a feature table that holds rows, whether it is the target under any case."""
    names = F.explode(F.array(*[F.lit(c) for c in features.columns])).alias("feature")
    return features.limit(1).select(names).withColumn("is_target", F.lower("feature") == label)


def representative_rate(df: DataFrame, label: str = "is_fraudulent", split: str = "split") -> DataFrame:
    """Fraud rate per split and whether it lies strictly inside the bounds (no labels: null and false)."""
    rates = df.groupBy(split).agg(F.avg(label).alias("fraud_rate"))
    inside = (F.col("fraud_rate") > RATE_BOUNDS[0]) & (F.col("fraud_rate") < RATE_BOUNDS[1])
    return rates.withColumn("representative", F.coalesce(inside, F.lit(False)))


def spread(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """Per (feature, split): sample std, min, max - the basis of O11 and O12."""
    return wide_stats(df, features, {"std": F.stddev_samp, "min_value": F.min, "max_value": F.max}, by=[split])


def near_constant(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """O11."""
    return spread(df, features, split).where(F.coalesce(F.col("std"), F.lit(0.0)) <= NEAR_CONSTANT_STD)


def extreme_ranges(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """O12."""
    s = spread(df, features, split)
    return s.where((F.abs("min_value") > EXTREME_ABS) | (F.abs("max_value") > EXTREME_ABS)).drop("std")


def class_presence(df: DataFrame, label: str = "is_fraudulent", split: str = "split") -> DataFrame:
    """O3 / M11."""
    return df.groupBy(split).agg(F.sum((F.col(label) == 1).cast("long")).alias("positives"),
                                 F.sum((F.col(label) == 0).cast("long")).alias("negatives")) \
        .withColumn("both_classes", (F.col("positives") > 0) & (F.col("negatives") > 0))


def order_violations(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose ``key`` is smaller than that of the row before them in ``order``; the table is in order if there are none.

    Neighbours are compared inside range partitions and across their borders: one exchange, no join."""
    n, down = descents(df, key, order)
    return df.sparkSession.createDataFrame([(n, down)], "n_rows long, n_out_of_order long")


def score_sanity(scored: DataFrame, threshold: float, score: str = "anomaly_score") -> DataFrame:
    """Spread, non-negative minimum, threshold inside the range, predictions not constant."""
    s = F.col(score)
    pred = (s > F.lit(threshold)).cast("int")
    a = scored.agg(F.stddev_pop(s).alias("std_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"),
                   F.min(pred).alias("_pmin"), F.max(pred).alias("_pmax"))
    return a.select("std_score", "min_score", "max_score", F.lit(threshold).alias("threshold"),
                    (F.col("std_score") > NEAR_CONSTANT_STD).alias("has_spread"),
                    (F.col("min_score") >= 0).alias("non_negative"),
                    ((F.lit(threshold) > 0) & (F.lit(threshold) < F.col("max_score"))).alias("threshold_inside"),
                    (F.col("_pmin") != F.col("_pmax")).alias("predictions_vary"))
