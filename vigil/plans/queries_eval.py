"""Driver queries over scores: evaluation (2.M), alerts (2.N), quality checks
(2.O) and the model (2.L). The score with an SQL oracle is ``amount_z_score``
on the card test split; the reconstruction model's scores are checked by
invariants instead."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import alerts as A
from vigil.operators import evaluate as E
from vigil.operators import quality as Q
from vigil.operators.model import AnomalyModel
from vigil.operators.scale import fit_scaler
from vigil.operators.split import shuffle_labels
from vigil.plans import prepare as P
from vigil.plans.common import rounded
from vigil.session import ensure_checkpoint_dir

KEYS = ("row_id", "split", "is_fraudulent")
RUN_SCORES = ["amount_z_score", "comprehensive_risk_score", "amount_ratio_to_median", "v_features_std",
              "hour_deviation"]
FIXED_THRESHOLD = 2.0


def scored(spark, sf):
    ft = P.card_features(spark, sf)[1]
    return ft.where(F.col("split") == "test").select(
        "row_id", "amount", "time", "is_fraudulent", F.col("amount_z_score").alias("anomaly_score"))


def _one_row(spark, d: dict, types: dict):
    schema = T.StructType([T.StructField(k, types.get(k, T.DoubleType())) for k in d])
    return spark.createDataFrame([tuple(d.values())], schema)


def q_score_threshold(spark, sf):
    s = scored(spark, sf)
    thr = E.threshold_at(s, "anomaly_score", 95)
    return rounded(_one_row(spark, {"percentile": 95, "threshold": thr}, {"percentile": T.IntegerType()}))


def q_threshold_sweep(spark, sf):
    s = scored(spark, sf)
    rows = E.sweep(s, "anomaly_score")
    return rounded(spark.createDataFrame(rows, "percentile int, threshold double"))


def q_score_stats(spark, sf):
    return rounded(_one_row(spark, E.score_stats(scored(spark, sf), "anomaly_score"), {}))


def q_roc_auc(spark, sf):
    return rounded(E.roc_auc(scored(spark, sf), "anomaly_score", "is_fraudulent"))


def _pred(spark, sf, pct=95, s=None):
    s = s if s is not None else scored(spark, sf)
    thr = E.threshold_at(s, "anomaly_score", pct)
    return E.predict(s, "anomaly_score", thr), thr


def q_binary_metrics(spark, sf):
    p, _ = _pred(spark, sf)
    return rounded(E.with_rates(E.confusion_counts(p, "predicted_fraud", "is_fraudulent"))
                   .select("precision", "recall", "f1"))


def q_confusion_long(spark, sf):
    p, _ = _pred(spark, sf)
    return E.confusion_long(p, "predicted_fraud", "is_fraudulent")


def q_accuracy(spark, sf):
    p, _ = _pred(spark, sf)
    return rounded(p.agg(F.avg((F.col("predicted_fraud") == F.col("is_fraudulent")).cast("double"))
                         .alias("accuracy")))


def q_fraud_rates(spark, sf):
    test = scored(spark, sf).agg(F.avg("is_fraudulent") * 100).first()[0]
    table = P.clean_card(spark, sf).agg(F.avg("is_fraudulent") * 100).first()[0]
    return rounded(_one_row(spark, {"test_fraud_rate_pct": test, "table_fraud_rate_pct": table}, {}))


def q_top_percent_performance(spark, sf):
    p, thr = _pred(spark, sf, 99)
    conf = E.with_rates(E.confusion_counts(p, "predicted_fraud", "is_fraudulent"))
    return rounded(conf.select((F.col("tp") + F.col("fp")).alias("flagged"), "tp", "fp", "fn", "precision",
                               "recall", F.lit(thr).alias("threshold")))


def q_class_distribution(spark, sf):
    df = P.card_split(spark, sf)
    return df.groupBy("split", "is_fraudulent").agg(F.count(F.lit(1)).alias("n"))


def q_best_run(spark, sf):
    ft = P.card_features(spark, sf)[1].where(F.col("split") == "test")
    runs = ft.select("is_fraudulent", F.explode(F.array(*[
        F.struct(F.lit(c).alias("run"), F.col(c).cast("double").alias("score")) for c in RUN_SCORES
    ])).alias("r")).select("is_fraudulent", "r.run", "r.score")
    auc = E.roc_auc(runs, "score", "is_fraudulent", by=["run"])
    auc = auc.persist()
    best = auc.agg(F.max_by("run", F.struct("roc_auc", F.col("run")))).first()[0]
    return rounded(auc.select("run", "roc_auc", (F.col("run") == F.lit(best)).alias("is_best")))


def q_alerts_default(spark, sf):
    top = A.top_alerts(scored(spark, sf), 99)
    return rounded(top.select("row_id", "anomaly_score", "predicted_fraud", "actual_fraud", "amount", "time"))


def q_alerts_summary(spark, sf):
    s = scored(spark, sf)
    return A.alert_summary(s, E.threshold_at(s, "anomaly_score", 99))


def q_alerts_at_percentile(spark, sf):
    top = A.top_alerts(scored(spark, sf), 95, flagged_only=True, k=None)
    return rounded(top.select("row_id", "anomaly_score", "actual_fraud", "amount"))


def q_alerts_fixed_threshold(spark, sf):
    return rounded(A.fixed_threshold(scored(spark, sf), FIXED_THRESHOLD))


def q_metric_report(spark, sf):
    s = scored(spark, sf)
    p, thr = _pred(spark, sf, s=s)
    conf = E.with_rates(E.confusion_counts(p, "predicted_fraud", "is_fraudulent"))
    auc = E.roc_auc(s, "anomaly_score", "is_fraudulent").first()["roc_auc"]
    return rounded(conf.withColumns({"roc_auc": F.lit(auc).cast("double"), "threshold": F.lit(thr)}))


# -- quality checks ----------------------------------------------------------

def q_check_temporal_order(spark, sf):
    return rounded(Q.temporal_order(P.card_split(spark, sf)))


def q_check_overlap(spark, sf):
    df = P.card_split(spark, sf)
    return Q.overlap(df.where(F.col("split") == "train"), df.where(F.col("split") == "test"), "row_id")


def q_check_id_overlap(spark, sf):
    from vigil.functions.clean import clean
    from vigil.operators.split import split_2way
    from vigil.sources.fixtures import card
    return Q.id_overlap(split_2way(clean(card(spark, sf, with_user=True))))


def _features(ft):
    return [c for c in ft.columns if c not in KEYS]


def q_check_stability(spark, sf):
    ft = P.card_features(spark, sf)[1]
    return rounded(Q.stability(ft, _features(ft)))


def q_check_stability_verdict(spark, sf):
    ft = P.card_features(spark, sf)[1]
    return Q.stability_verdict(ft, _features(ft))


def q_check_target_absent(spark, sf):
    ft = P.card_features(spark, sf, keep=("row_id", "split"))[1]  # the target is not asked for
    return Q.target_absent(ft.drop("row_id", "split"))


def q_check_representative_rate(spark, sf):
    return rounded(Q.representative_rate(P.card_split(spark, sf)))


def q_check_near_constant(spark, sf):
    ft = P.card_features(spark, sf)[1]
    return Q.near_constant(ft, _features(ft)).select("feature", "split")


def q_check_ranges(spark, sf):
    ft = P.shop_features(spark, sf)[1]
    return rounded(Q.extreme_ranges(ft, _features(ft)))


def q_check_class_presence(spark, sf):
    return Q.class_presence(P.card_split(spark, sf))


def q_check_separation(spark, sf):
    return rounded(scored(spark, sf).groupBy("is_fraudulent").agg(
        F.avg("anomaly_score").alias("mean_score"), F.count(F.lit(1)).alias("n")))


def q_check_order(spark, sf):
    return Q.order_violations(P.clean_card(spark, sf), "row_id", ["transaction_date", "row_id"])


def q_check_score_sanity(spark, sf):
    s = scored(spark, sf)
    return rounded(Q.score_sanity(s, E.threshold_at(s, "anomaly_score", 95)))


def q_check_params_from_train(spark, sf):
    fitted = P.fit_features(P.card_split(spark, sf))
    names = ["amount_25", "amount_50", "amount_75", "amount_90", "amount_95", "amount_center", "amount_scale",
             "hour_mean", "hour_std"]
    return rounded(spark.createDataFrame([(n, float(fitted.params[n])) for n in names], "param string, value double"))


def q_check_shuffled_auc(spark, sf):
    s = scored(spark, sf)
    return rounded(E.roc_auc(shuffle_labels(s, "is_fraudulent", seed=42), "anomaly_score", "is_fraudulent")
                   .withColumn("in_band", (F.col("roc_auc") > 0.4) & (F.col("roc_auc") < 0.6)))


def q_check_round_trip(spark, sf):
    """Features and scores equal after a write / read through the shared checkpoint folder."""
    s = scored(spark, sf)
    path = os.path.join(ensure_checkpoint_dir(spark), f"roundtrip-{uuid.uuid4().hex}")
    s.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    j = s.alias("a").join(back.alias("b"), "row_id", "full")
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.max(F.abs(F.col("a.anomaly_score") - F.col("b.anomaly_score"))).alias("max_score_diff"),
                 F.sum((F.col("a.is_fraudulent") != F.col("b.is_fraudulent")).cast("long")).alias("label_diffs"),
                 F.sum(F.col("b.row_id").isNull().cast("long")).alias("missing"))


# -- model -----------------------------------------------------------------

def _standardized(spark, sf):
    ft = P.card_features(spark, sf)[1]
    feats = _features(ft)
    scaler = fit_scaler(ft.where(F.col("split") == "train"), feats)
    return scaler, ft, feats


def q_standardize(spark, sf):
    from vigil.operators.quality import wide_stats
    scaler, ft, feats = _standardized(spark, sf)
    z = scaler.transform(ft.where(F.col("split") == "test"), keep=("row_id",))
    return wide_stats(z, feats, {
        "total": lambda x: F.sum(F.round(x, 6).cast("decimal(38,6)")).cast("double"),
        "min_value": lambda x: F.round(F.min(x), 6), "max_value": lambda x: F.round(F.max(x), 6)})


def linear_model(spark, sf, latent_dim=16, percentile=95):
    """2-way flow: standardise on all train rows, fit on normal train rows, threshold on their scores."""
    split = P.card_split(spark, sf)
    return AnomalyModel.fit(split.where(F.col("split") == "train").drop("split"), latent_dim, percentile), split.where(F.col("split") == "test").drop("split")


def q_linear_scores(spark, sf):
    model, test = linear_model(spark, sf)
    return rounded(model.predict(test))


def q_linear_auc(spark, sf):
    model, test = linear_model(spark, sf)
    return rounded(E.roc_auc(model.score(test), "anomaly_score", "is_fraudulent"))


def q_feature_importance(spark, sf):
    model, _ = linear_model(spark, sf)
    return rounded(spark.createDataFrame(model.linear.importance(), "feature string, importance double"))


QUERIES = {
    "score_threshold": q_score_threshold, "threshold_sweep": q_threshold_sweep, "score_stats": q_score_stats,
    "roc_auc": q_roc_auc, "binary_metrics": q_binary_metrics, "confusion_long": q_confusion_long,
    "accuracy": q_accuracy, "fraud_rates": q_fraud_rates, "top_percent_performance": q_top_percent_performance,
    "class_distribution": q_class_distribution, "best_run": q_best_run,
    "alerts_default": q_alerts_default, "alerts_summary": q_alerts_summary,
    "alerts_at_percentile": q_alerts_at_percentile, "alerts_fixed_threshold": q_alerts_fixed_threshold,
    "metric_report": q_metric_report,
    "check_temporal_order": q_check_temporal_order, "check_overlap": q_check_overlap,
    "check_id_overlap": q_check_id_overlap, "check_stability": q_check_stability, "check_stability_verdict": q_check_stability_verdict,
    "check_target_absent": q_check_target_absent, "check_representative_rate": q_check_representative_rate,
    "check_near_constant": q_check_near_constant, "check_ranges": q_check_ranges,
    "check_class_presence": q_check_class_presence, "check_separation": q_check_separation,
    "check_order": q_check_order, "check_score_sanity": q_check_score_sanity,
    "check_params_from_train": q_check_params_from_train, "check_shuffled_auc": q_check_shuffled_auc,
    "check_round_trip": q_check_round_trip,
    "standardize": q_standardize, "linear_scores": q_linear_scores, "linear_auc": q_linear_auc,
    "feature_importance": q_feature_importance,
}


def q_flagged_by_hour(spark, sf):
    """Flagship: scan -> clean -> split -> fit -> features -> score -> flags -> counts by hour."""
    ft = P.card_features(spark, sf)[1].where(F.col("split") == "test")
    s = ft.select("row_id", "hour", "amount", "is_fraudulent", F.col("amount_z_score").alias("anomaly_score"))
    p = E.predict(s, "anomaly_score", E.threshold_at(s, "anomaly_score", 95))
    return rounded(p.groupBy("hour").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("predicted_fraud").cast("long").alias("n_flagged"),
        F.sum(F.when(F.col("predicted_fraud") == 1, F.col("amount")).otherwise(0.0)).alias("flagged_amount"),
        F.sum((F.col("predicted_fraud") * F.col("is_fraudulent")).cast("long")).alias("n_caught")))


QUERIES["flagged_by_hour"] = q_flagged_by_hour
