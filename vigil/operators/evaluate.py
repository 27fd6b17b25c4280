"""Evaluation and score aggregates.

Exact ROC AUC uses the Mann-Whitney form over distinct scores:
AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N), with ``neg_below`` an
exclusive prefix sum over the score order (``prefix_sums``), so ties are
averaged and no group of rows is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.rank import prefix_sums
from vigil.operators.select import exact_quantiles

SWEEP = [50, 75, 80, 85, 90, 92, 94, 95, 96, 97, 98, 99]  # fixed values: percentile sweep


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact AUC per group (``by``); null when a group has one class only."""
    by = list(by)
    y = F.col(label)
    g = (df.where(F.col(score).isNotNull() & y.isNotNull())
         .groupBy(*by, score).agg(F.sum((y == 1).cast("long")).alias("_pos"),
                                  F.sum((y != 1).cast("long")).alias("_neg")))
    pre = prefix_sums(g, [*by, score], {"_cn": "_neg"})
    if by:
        start = pre.groupBy(*by).agg(F.min("_cn").alias("_start"))
        pre = pre.join(start, by).withColumn("_cn", F.col("_cn") - F.col("_start"))
    contrib = F.col("_pos") * (F.col("_cn") + F.col("_neg") / 2.0)
    agg = [F.sum(contrib).alias("_u"), F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives")]
    res = pre.groupBy(*by).agg(*agg) if by else pre.agg(*agg)
    return res.select(*by, F.try_divide(F.col("_u"), F.col("positives").cast("double") * F.col("negatives"))
                      .alias("roc_auc"), F.col("positives").cast("long"), F.col("negatives").cast("long"))


def confusion_counts(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """M3: tn, fp, fn, tp (null label counts as normal)."""
    p = F.col(pred) == 1
    a = F.coalesce(F.col(label), F.lit(0)) == 1
    aggs = [F.sum((~p & ~a).cast("long")).alias("tn"), F.sum((p & ~a).cast("long")).alias("fp"),
            F.sum((~p & a).cast("long")).alias("fn"), F.sum((p & a).cast("long")).alias("tp")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def with_rates(conf: DataFrame) -> DataFrame:
    """M2 / M5 from confusion counts: zero when undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return conf.withColumns({"precision": prec, "recall": rec}).withColumns({
        "f1": F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                      F.col("precision") + F.col("recall")), F.lit(0.0)),
        "accuracy": F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0))})


def predict(df: DataFrame, score: str, threshold: float, name: str = "predicted_fraud") -> DataFrame:
    """Strict ``score > threshold``."""
    return df.withColumn(name, F.coalesce(F.col(score) > F.lit(threshold), F.lit(False)).cast("int"))


def threshold_at(df: DataFrame, score: str, percentile: float) -> float | None:
    """Linear-interpolated percentile of the scores."""
    return exact_quantiles(df, [score], [percentile / 100.0])[()][score][0]


def sweep(df: DataFrame, score: str, percentiles: Sequence[int] = SWEEP) -> list[tuple[int, float]]:
    """M7: thresholds at several percentiles from one quantile pass."""
    vals = exact_quantiles(df, [score], [p / 100.0 for p in percentiles])[()][score]
    return list(zip(percentiles, vals))


def score_stats(df: DataFrame, score: str) -> dict:
    """M8: min, max, mean, median, population std and fixed percentiles."""
    s = F.col(score)
    r = df.agg(F.min(s).alias("min_score"), F.max(s).alias("max_score"), F.avg(s).alias("mean_score"),
               F.stddev_pop(s).alias("std_score")).first().asDict()
    probs = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    q = exact_quantiles(df, [score], probs)[()][score]
    r["median_score"] = q[1]
    for p, v in zip((25, 50, 75, 90, 95, 99), q):
        r[f"p{p}"] = v
    return r


def confusion_long(df: DataFrame, pred: str, label: str) -> DataFrame:
    """M4: (actual, predicted, n)."""
    return df.groupBy(F.coalesce(F.col(label), F.lit(0)).alias("actual"), F.col(pred).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))
