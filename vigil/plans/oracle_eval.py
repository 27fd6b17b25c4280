"""DuckDB oracle SQL for evaluation, alert and quality queries."""

from __future__ import annotations

from vigil.plans import oracle_base as B
from vigil.plans.queries_eval import FIXED_THRESHOLD, RUN_SCORES
from vigil.operators.evaluate import SWEEP

CARD = B.CARD_FEATURES
SCORED = """scored AS (
  SELECT row_id, amount, time, is_fraudulent, amount_z_score AS anomaly_score FROM card_f WHERE split = 'test')"""
S = [*CARD, SCORED]


def thr(p: int) -> str:
    return f"thr AS (SELECT quantile_cont(anomaly_score, {p / 100}) AS t FROM scored)"


PRED = [*S, thr(95), """pred AS (
  SELECT s.*, CAST(coalesce(s.anomaly_score > thr.t, false) AS INTEGER) AS predicted_fraud
  FROM scored s CROSS JOIN thr)"""]

CONF = """conf AS (
  SELECT CAST(sum(CASE WHEN predicted_fraud = 0 AND is_fraudulent = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN predicted_fraud = 1 AND is_fraudulent = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN predicted_fraud = 0 AND is_fraudulent = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN predicted_fraud = 1 AND is_fraudulent = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM pred),
rates AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
         coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0) AS accuracy FROM conf),
rates2 AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM rates)"""

# AUC with ties averaged: rank-sum of the positives (average ranks over tied scores).
AUC = """ranks AS (
  SELECT is_fraudulent, (rank() OVER (ORDER BY anomaly_score) + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0)
         AS avg_rank FROM scored WHERE anomaly_score IS NOT NULL),
auc AS (
  SELECT (sum(CASE WHEN is_fraudulent = 1 THEN avg_rank ELSE 0 END)
          - sum(is_fraudulent) * (sum(is_fraudulent) + 1) / 2.0)
         / nullif(CAST(sum(is_fraudulent) AS DOUBLE) * sum(1 - is_fraudulent), 0) AS roc_auc,
         CAST(sum(is_fraudulent) AS BIGINT) AS positives, CAST(sum(1 - is_fraudulent) AS BIGINT) AS negatives
  FROM ranks)"""

_SWEEP = " UNION ALL ".join(
    f"SELECT {p} AS percentile, round(quantile_cont(anomaly_score, {p / 100}), 6) AS threshold FROM scored"
    for p in SWEEP)

_RUNS = " UNION ALL ".join(
    f"SELECT '{c}' AS run, is_fraudulent, CAST({c} AS DOUBLE) AS score FROM card_f WHERE split = 'test'"
    for c in RUN_SCORES)

_STABILITY = B.with_(*CARD, final="""
, long AS (UNPIVOT (SELECT split, CAST(COLUMNS(* EXCLUDE (row_id, split, is_fraudulent)) AS DOUBLE) FROM card_f)
           ON COLUMNS(* EXCLUDE (split)) INTO NAME feature VALUE value),
m AS (SELECT feature, avg(CASE WHEN split = 'train' THEN value END) AS train_mean,
             avg(CASE WHEN split = 'test' THEN value END) AS test_mean FROM long GROUP BY feature)
SELECT feature, round(train_mean, 6) AS train_mean, round(test_mean, 6) AS test_mean,
       coalesce(CASE WHEN train_mean = 0 THEN abs(test_mean) < 1
                     ELSE abs(test_mean - train_mean) / abs(train_mean) < 0.5 END, false) AS stable
FROM m""")

ORACLE = {
    "score_threshold": B.with_(*S, final="""
SELECT 95 AS percentile, round(quantile_cont(anomaly_score, 0.95), 6) AS threshold FROM scored"""),
    "threshold_sweep": B.with_(*S, final=_SWEEP),
    "score_stats": B.with_(*S, final="""
SELECT round(min(anomaly_score), 6) AS min_score, round(max(anomaly_score), 6) AS max_score,
       round(avg(anomaly_score), 6) AS mean_score, round(stddev_pop(anomaly_score), 6) AS std_score,
       round(quantile_cont(anomaly_score, 0.5), 6) AS median_score,
       round(quantile_cont(anomaly_score, 0.25), 6) AS p25, round(quantile_cont(anomaly_score, 0.5), 6) AS p50,
       round(quantile_cont(anomaly_score, 0.75), 6) AS p75, round(quantile_cont(anomaly_score, 0.9), 6) AS p90,
       round(quantile_cont(anomaly_score, 0.95), 6) AS p95, round(quantile_cont(anomaly_score, 0.99), 6) AS p99
FROM scored"""),
    "roc_auc": B.with_(*S, AUC, final="SELECT round(roc_auc, 6) AS roc_auc, positives, negatives FROM auc"),
    "binary_metrics": B.with_(*PRED, CONF, final="""
SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rates2"""),
    "confusion_long": B.with_(*PRED, final="""
SELECT is_fraudulent AS actual, predicted_fraud AS predicted, count(*) AS n FROM pred GROUP BY 1, 2"""),
    "accuracy": B.with_(*PRED, final="""
SELECT round(avg(CASE WHEN predicted_fraud = is_fraudulent THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred"""),
    "fraud_rates": B.with_(*S, final="""
SELECT round((SELECT avg(is_fraudulent) FROM scored) * 100, 6) AS test_fraud_rate_pct,
       round((SELECT avg(is_fraudulent) FROM clean_card) * 100, 6) AS table_fraud_rate_pct"""),
    "top_percent_performance": B.with_(*S, thr(99), """pred AS (
  SELECT s.*, CAST(coalesce(s.anomaly_score > thr.t, false) AS INTEGER) AS predicted_fraud
  FROM scored s CROSS JOIN thr)""", CONF, final="""
SELECT tp + fp AS flagged, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round((SELECT t FROM thr), 6) AS threshold FROM rates2"""),
    "class_distribution": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT split, is_fraudulent, count(*) AS n FROM card_split GROUP BY 1, 2"""),
    "best_run": B.with_(*CARD, final=f"""
, runs AS ({_RUNS}),
r AS (SELECT run, is_fraudulent,
        rank() OVER (PARTITION BY run ORDER BY score)
        + (count(*) OVER (PARTITION BY run, score) - 1) / 2.0 AS avg_rank FROM runs WHERE score IS NOT NULL),
a AS (SELECT run, (sum(CASE WHEN is_fraudulent = 1 THEN avg_rank ELSE 0 END)
                   - sum(is_fraudulent) * (sum(is_fraudulent) + 1) / 2.0)
                  / nullif(CAST(sum(is_fraudulent) AS DOUBLE) * sum(1 - is_fraudulent), 0) AS roc_auc
      FROM r GROUP BY run)
SELECT run, round(roc_auc, 6) AS roc_auc, run = (SELECT arg_max(run, (roc_auc, run)) FROM a) AS is_best
FROM a"""),
    "alerts_default": B.with_(*S, thr(99), final="""
SELECT s.row_id, round(s.anomaly_score, 6) AS anomaly_score,
       CAST(coalesce(s.anomaly_score > thr.t, false) AS INTEGER) AS predicted_fraud,
       s.is_fraudulent AS actual_fraud, round(s.amount, 6) AS amount, round(s.time, 6) AS time
FROM scored s CROSS JOIN thr ORDER BY s.anomaly_score DESC, s.row_id LIMIT 100"""),
    "alerts_summary": B.with_(*S, thr(99), """pred AS (
  SELECT s.*, CAST(coalesce(s.anomaly_score > thr.t, false) AS INTEGER) AS predicted_fraud
  FROM scored s CROSS JOIN thr)""", CONF, final="""
SELECT tn + fp + fn + tp AS total, tp + fp AS flagged, tp + fn AS actual_fraud, tp, fp, fn, tn FROM conf"""),
    "alerts_at_percentile": B.with_(*S, thr(95), final="""
SELECT s.row_id, round(s.anomaly_score, 6) AS anomaly_score, s.is_fraudulent AS actual_fraud,
       round(s.amount, 6) AS amount
FROM scored s CROSS JOIN thr WHERE s.anomaly_score > thr.t"""),
    "alerts_fixed_threshold": B.with_(*S, final=f"""
SELECT count(*) AS total, CAST(sum(CASE WHEN anomaly_score > {FIXED_THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
       count(*) - CAST(sum(CASE WHEN anomaly_score > {FIXED_THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS normal,
       round(coalesce(sum(CASE WHEN anomaly_score > {FIXED_THRESHOLD} THEN 1 ELSE 0 END) * 100.0
                      / nullif(count(*), 0), 0.0), 6) AS fraud_rate_pct
FROM scored"""),
    "metric_report": B.with_(*PRED, CONF, AUC, final="""
SELECT tn, fp, fn, tp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       round(accuracy, 6) AS accuracy, round((SELECT roc_auc FROM auc), 6) AS roc_auc,
       round((SELECT t FROM thr), 6) AS threshold
FROM rates2"""),
    "check_temporal_order": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
, a AS (SELECT max(CASE WHEN split = 'train' THEN transaction_date END) AS max_train,
               min(CASE WHEN split = 'test' THEN transaction_date END) AS min_test FROM card_split)
SELECT epoch_us(max_train) AS max_train, epoch_us(min_test) AS min_test, min_test > max_train AS ordered FROM a"""),
    "check_overlap": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT count(*) AS n_overlap FROM (
  SELECT DISTINCT row_id FROM card_split WHERE split = 'train'
  INTERSECT SELECT DISTINCT row_id FROM card_split WHERE split = 'test')"""),
    "check_id_overlap": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
, u AS (SELECT s.split, s.row_id, e.user_id FROM card_split s JOIN events e ON e.event_id = s.row_id),
o AS (
  SELECT 'row_id' AS "column", count(*) AS n_overlap FROM (
    SELECT DISTINCT row_id FROM u WHERE split = 'train' INTERSECT SELECT DISTINCT row_id FROM u WHERE split = 'test')
  UNION ALL
  SELECT 'user_id', count(*) FROM (
    SELECT DISTINCT user_id FROM u WHERE split = 'train' INTERSECT SELECT DISTINCT user_id FROM u WHERE split = 'test'))
SELECT "column", n_overlap, n_overlap > 0 AS leak FROM o"""),
    "check_stability": _STABILITY,
    "predict_reloaded": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT row_id, 96 AS n_features, true AS same_features, true AS same_score, true AS same_label, true AS same_target, true AS non_negative
FROM card_split WHERE split = 'test'"""),
    "stream_agreement": B.with_(B.CARD, final="""
SELECT row_id, true AS same_score, true AS same_label FROM card"""),
    "check_class_presence": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT split, CAST(sum(CASE WHEN is_fraudulent = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
       CAST(sum(CASE WHEN is_fraudulent = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
       sum(CASE WHEN is_fraudulent = 1 THEN 1 ELSE 0 END) > 0
         AND sum(CASE WHEN is_fraudulent = 0 THEN 1 ELSE 0 END) > 0 AS both_classes
FROM card_split GROUP BY split"""),
    "check_separation": B.with_(*S, final="""
SELECT is_fraudulent, round(avg(anomaly_score), 6) AS mean_score, count(*) AS n FROM scored GROUP BY 1"""),
    "check_order": B.with_(B.CARD, B.CLEAN_CARD, final="""
, r AS (SELECT row_id, lag(row_id) OVER (ORDER BY transaction_date, row_id) AS previous FROM clean_card)
SELECT count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN row_id < previous THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_out_of_order FROM r"""),
    "check_score_sanity": B.with_(*S, thr(95), final="""
, a AS (SELECT stddev_pop(anomaly_score) AS std_score, min(anomaly_score) AS min_score,
               max(anomaly_score) AS max_score,
               min(CAST(anomaly_score > (SELECT t FROM thr) AS INTEGER)) AS pmin,
               max(CAST(anomaly_score > (SELECT t FROM thr) AS INTEGER)) AS pmax FROM scored)
SELECT round(std_score, 6) AS std_score, round(min_score, 6) AS min_score, round(max_score, 6) AS max_score,
       round((SELECT t FROM thr), 6) AS threshold, std_score > 1e-10 AS has_spread, min_score >= 0 AS non_negative,
       (SELECT t FROM thr) > 0 AND (SELECT t FROM thr) < max_score AS threshold_inside, pmin <> pmax AS predictions_vary
FROM a"""),
    "check_params_from_train": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, B.CARD_P, final="""
SELECT 'amount_25' AS param, round(a25, 6) AS value FROM card_p
UNION ALL SELECT 'amount_50', round(a50, 6) FROM card_p
UNION ALL SELECT 'amount_75', round(a75, 6) FROM card_p
UNION ALL SELECT 'amount_90', round(a90, 6) FROM card_p
UNION ALL SELECT 'amount_95', round(a95, 6) FROM card_p
UNION ALL SELECT 'amount_center', round(a50, 6) FROM card_p
UNION ALL SELECT 'amount_scale', round(CASE WHEN a75 - a25 = 0 THEN 1.0 ELSE a75 - a25 END, 6) FROM card_p
UNION ALL SELECT 'hour_mean', round(hmean, 6) FROM card_p
UNION ALL SELECT 'hour_std', round(hstd, 6) FROM card_p"""),
}


def _long(table: str, exclude: str = "row_id, is_fraudulent") -> str:
    return f"""long AS (UNPIVOT (SELECT * EXCLUDE ({exclude}) FROM {table})
           ON COLUMNS(* EXCLUDE (split)) INTO NAME feature VALUE value)"""


ORACLE.update({
    "check_ranges": B.with_(*B.SHOP_FEATURES, _long("shop_f"), final="""
, s AS (SELECT feature, split, min(CAST(value AS DOUBLE)) AS min_value, max(CAST(value AS DOUBLE)) AS max_value
        FROM long GROUP BY feature, split)
SELECT feature, split, round(min_value, 6) AS min_value, round(max_value, 6) AS max_value FROM s
WHERE abs(min_value) > 1e6 OR abs(max_value) > 1e6"""),
    "check_near_constant": B.with_(*CARD, _long("card_f"), final="""
SELECT feature, split FROM long GROUP BY feature, split
HAVING coalesce(stddev_samp(CAST(value AS DOUBLE)), 0) <= 1e-10"""),
    "standardize": B.with_(*CARD, _long("card_f"), final="""
, st AS (SELECT feature, avg(CAST(value AS DOUBLE)) AS m,
                CASE WHEN coalesce(stddev_pop(CAST(value AS DOUBLE)), 0) = 0 THEN 1.0
                     ELSE stddev_pop(CAST(value AS DOUBLE)) END AS sd
         FROM long WHERE split = 'train' GROUP BY feature),
z AS (SELECT l.feature, (CAST(l.value AS DOUBLE) - st.m) / st.sd AS value
      FROM long l JOIN st USING (feature) WHERE l.split = 'test')
SELECT feature, CAST(sum(CAST(round(value, 6) AS DECIMAL(38,6))) AS DOUBLE) AS total,
       round(min(value), 6) AS min_value, round(max(value), 6) AS max_value FROM z GROUP BY feature"""),
})

ORACLE["flagged_by_hour"] = B.with_(*CARD, """s AS (
  SELECT row_id, hour, amount, is_fraudulent, amount_z_score AS anomaly_score FROM card_f WHERE split = 'test')""",
                                    """t AS (SELECT quantile_cont(anomaly_score, 0.95) AS t FROM s)""", final="""
, p AS (SELECT s.*, CAST(coalesce(s.anomaly_score > t.t, false) AS INTEGER) AS predicted_fraud FROM s CROSS JOIN t)
SELECT hour, count(*) AS n_rows, CAST(sum(predicted_fraud) AS BIGINT) AS n_flagged,
       round(sum(CASE WHEN predicted_fraud = 1 THEN amount ELSE 0.0 END), 6) AS flagged_amount,
       CAST(sum(predicted_fraud * is_fraudulent) AS BIGINT) AS n_caught
FROM p GROUP BY hour""")

ORACLE.update({
    "check_stability_verdict": f"""SELECT count(*) AS n_features, count(*) FILTER (WHERE stable) AS n_stable,
       count(*) FILTER (WHERE stable) > 0.8 * count(*) AS stable FROM ({_STABILITY})""",
    "check_target_absent": B.with_(*CARD, final="""
, one AS (SELECT coalesce(COLUMNS(* EXCLUDE (row_id, split, is_fraudulent)), 0) FROM card_f LIMIT 1)
SELECT feature, lower(feature) = 'is_fraudulent' AS is_target
FROM (UNPIVOT one ON COLUMNS(*) INTO NAME feature VALUE value)"""),
    "check_representative_rate": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT split, round(avg(is_fraudulent), 6) AS fraud_rate, avg(is_fraudulent) > 0.0001 AND avg(is_fraudulent) < 0.01 AS representative
FROM card_split GROUP BY split"""),
    "event_time": B.with_(B.CARD, final="""
SELECT row_id, epoch_us(TIMESTAMP '2023-01-01 00:00:00') + CAST(round(time * 1000000) AS BIGINT) AS transaction_us FROM card"""),
})
