"""Alert queries over a scored table (N1-N6), batch re-aims of the serving
endpoints. Ranking is ``orderBy(score desc, row_id).limit(k)`` - a top-k whose
limit is the feature (TakeOrderedAndProject keeps k rows per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.evaluate import confusion_counts, predict, threshold_at

DEFAULT_PERCENTILE = 99
DEFAULT_TOP = 100
# fixed values: the columns that an alert shows
DISPLAY = ["amount", "time", *[f"v{i}" for i in range(1, 29)], "amount_log", "amount_sqrt", "amount_scaled", "amount_above_95",
           "amount_ratio_to_median", "hour", "day_of_week", "is_weekend", "is_business_hours", "comprehensive_risk_score", "high_risk"]


def classify_and_rank(scored: DataFrame, threshold: float, labels: DataFrame | None = None,
                      score: str = "anomaly_score", label: str = "is_fraudulent") -> DataFrame:
    """N1 + N4: predicted flag, label looked up by row id (null when missing), ordered by score."""
    df = predict(scored, score, threshold)
    if labels is not None:
        df = df.drop(label) if label in df.columns else df
        df = df.join(labels.select("row_id", F.col(label)), "row_id", "left")
    return df.withColumn("actual_fraud", F.col(label)).orderBy(F.col(score).desc(), F.col("row_id"))


def top_alerts(scored: DataFrame, percentile: float = DEFAULT_PERCENTILE, flagged_only: bool = False,
               k: int | None = DEFAULT_TOP, score: str = "anomaly_score") -> DataFrame:
    """N2 (all rows, the ``k`` highest) and N3 (``flagged_only``); ``k=None`` returns every row asked for."""
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be within [0, 100]")
    thr = threshold_at(scored, score, percentile)
    ranked = classify_and_rank(scored, thr, score=score)
    if flagged_only:
        ranked = ranked.where(F.col("predicted_fraud") == 1)
    return ranked if k is None else ranked.limit(k)


def alert_summary(scored: DataFrame, threshold: float, score: str = "anomaly_score",
                  label: str = "is_fraudulent") -> DataFrame:
    """Summary counts with real values even when nothing is flagged."""
    conf = confusion_counts(predict(scored, score, threshold), "predicted_fraud", label)
    return conf.select(
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("total"),
        (F.col("tp") + F.col("fp")).alias("flagged"), (F.col("tp") + F.col("fn")).alias("actual_fraud"),
        "tp", "fp", "fn", "tn")


def fixed_threshold(scored: DataFrame, threshold: float, score: str = "anomaly_score") -> DataFrame:
    """Total, flagged, normal and the flagged share in percent."""
    flagged = F.sum((F.col(score) > F.lit(threshold)).cast("long"))
    return scored.agg(F.count(F.lit(1)).alias("total"), flagged.alias("flagged")).select(
        "total", "flagged", (F.col("total") - F.col("flagged")).alias("normal"),
        F.coalesce(F.try_divide(F.col("flagged") * 100.0, F.col("total")), F.lit(0.0)).alias("fraud_rate_pct"))
