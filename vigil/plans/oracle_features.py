"""DuckDB oracle SQL for the feature-side driver queries."""

from __future__ import annotations

from vigil.plans import oracle_base as B
from vigil.plans.queries_features import (AMOUNT_COLS, BEHAVIOR_COLS, CARD_INTER_COLS, CARD_RISK_COLS,
                                          CUSTOMER_COLS, SHOP_INTER_COLS, SHOP_RISK_COLS, TEMPORAL_COLS,
                                          V_STAT_COLS, VELOCITY_COLS)

DOUBLE_HINT = ("log", "sqrt", "scaled", "ratio", "volatility", "mean", "std", "max", "min", "range", "sin",
               "cos", "deviation", "interaction", "score", "freq", "rate", "weeks", "months", "per_day",
               "per_item", "efficiency", "velocity", "per_transaction")
INT_COLS = {"hour", "day_of_week", "day_of_month", "month", "quarter", "age_group_encoded", "age_risk",
            "account_age_risk", "payment_method_encoded", "product_category_encoded", "device_used_encoded",
            "payment_product_interaction", "age_account_interaction", "high_amount_velocity",
            "high_quantity_velocity"}


def _col(c: str, digits: bool = True) -> str:
    if c in INT_COLS or c.startswith(("is_", "amount_above", "quantity_above", "new_", "recent_", "old_",
                                      "established_", "young_", "senior_", "rare_", "high_", "low_", "medium_",
                                      "unusual_", "suspicious_", "weekend_", "rush_", "multi_",
                                      "sophisticated_", "foreign_", "velocity_anomaly", "amount_outlier",
                                      "quantity_outlier", "v_features_outlier")):
        if c != "velocity_risk_score" and not c.endswith(("_rate", "_score")):
            return f"coalesce({c}, 0) AS {c}"
    value = f"coalesce(CAST({c} AS DOUBLE), 0)"
    return f"round({value}, 6) AS {c}" if digits else f"{value} AS {c}"


def _subset(ctes, table, cols, digits=True):
    return B.with_(*ctes, final=f"SELECT row_id, split, {', '.join(_col(c, digits) for c in cols)} FROM {table}")


CARD = B.CARD_FEATURES
SHOP = B.SHOP_FEATURES

CHECKSUM_KEYS = ("row_id", "split", "is_fraudulent")


def _checksums(ctes, table):
    return B.with_(*ctes, final=f"""
, long AS (UNPIVOT (SELECT * EXCLUDE (row_id, is_fraudulent) FROM {table})
           ON COLUMNS(* EXCLUDE (split)) INTO NAME feature VALUE value)
SELECT feature, split, CAST(sum(CAST(round(CAST(value AS DOUBLE), 6) AS DECIMAL(38,6))) AS DOUBLE) AS total,
       CAST(sum(CASE WHEN value <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_nonzero,
       round(min(CAST(value AS DOUBLE)), 6) AS min_value, round(max(CAST(value AS DOUBLE)), 6) AS max_value
FROM long GROUP BY feature, split""")


ORACLE = {
    "clean_card": B.with_(B.CARD, B.CLEAN_CARD, final="""
SELECT row_id, round(time, 6) AS time, round(amount, 6) AS amount, epoch_us(transaction_date) AS transaction_us,
       transaction_hour, is_fraudulent FROM clean_card"""),
    "clean_shop": B.with_(B.SHOP, B.CLEAN_SHOP, final="""
SELECT row_id, epoch_us(transaction_date) AS transaction_us, round(transaction_amount, 6) AS transaction_amount,
       round(quantity, 6) AS quantity, customer_age, account_age_days, customer_location, payment_method,
       product_category, device_used, is_fraudulent, transaction_hour FROM clean_shop"""),
    "split_80_10_10": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, final="""
SELECT row_id, CASE WHEN pos < floor(0.8 * n) THEN 'train'
                    WHEN pos < floor(0.8 * n) + floor(0.1 * n) THEN 'val' ELSE 'test' END AS split
FROM card_pos"""),
    "split_80_20": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
SELECT row_id, split FROM card_split"""),
    "split_90_10": B.with_(B.SHOP, B.CLEAN_SHOP, final="""
SELECT row_id, CASE WHEN row_id < floor(0.9 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split
FROM clean_shop"""),
    "split_report": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, final="""
, s AS (SELECT *, CASE WHEN pos < floor(0.8 * n) THEN 'train'
                       WHEN pos < floor(0.8 * n) + floor(0.1 * n) THEN 'val' ELSE 'test' END AS split
        FROM card_pos)
SELECT split, count(*) AS n_rows, CAST(sum(is_fraudulent) AS BIGINT) AS positives,
       round(avg(is_fraudulent), 6) AS fraud_rate, round(count(*) / max(n), 6) AS fraction
FROM s GROUP BY split"""),
    "tail_validation_rows": B.with_(B.CARD, B.CLEAN_CARD, B.CARD_POS, B.CARD_SPLIT, final="""
, normal AS (SELECT row_id, row_number() OVER (ORDER BY transaction_date, row_id) - 1 AS p,
                    count(*) OVER () AS m
             FROM card_split WHERE split = 'train' AND is_fraudulent = 0)
SELECT row_id, CAST(p >= m - floor(0.2 * m) AS INTEGER) AS is_tail FROM normal"""),
    "amount_features": _subset(CARD, "card_f", AMOUNT_COLS),
    "v_statistics": _subset(CARD, "card_f", V_STAT_COLS),
    "temporal_features": _subset(CARD, "card_f", TEMPORAL_COLS),
    "hour_deviation": _subset(SHOP, "shop_f", ["hour", "hour_deviation"]),
    "customer_features": _subset(SHOP, "shop_f", CUSTOMER_COLS),
    "behavior_features": _subset(SHOP, "shop_f", BEHAVIOR_COLS, digits=False),
    "velocity_features": _subset(SHOP, "shop_f", VELOCITY_COLS, digits=False),
    "interactions_card": _subset(CARD, "card_f", CARD_INTER_COLS),
    "interactions_shop": _subset(SHOP, "shop_f", SHOP_INTER_COLS),
    "risk_flags_card": _subset(CARD, "card_f", CARD_RISK_COLS),
    "risk_flags_shop": _subset(SHOP, "shop_f", SHOP_RISK_COLS),
    "risk_bands": B.with_(*CARD, *SHOP[:-1], SHOP[-1], final="""
, both_shapes AS (SELECT 'card' AS shape, split, low_risk, medium_risk, high_risk, comprehensive_risk_score FROM card_f
           UNION ALL
           SELECT 'shop', split, low_risk, medium_risk, high_risk, comprehensive_risk_score FROM shop_f)
SELECT shape, split, count(*) AS n_rows, CAST(sum(low_risk) AS BIGINT) AS n_low,
       CAST(sum(medium_risk) AS BIGINT) AS n_medium, CAST(sum(high_risk) AS BIGINT) AS n_high,
       round(avg(comprehensive_risk_score), 6) AS mean_score, round(max(comprehensive_risk_score), 6) AS max_score
FROM both_shapes GROUP BY shape, split"""),
    "label_codes": B.with_(B.SHOP, B.CLEAN_SHOP, B.SHOP_SPLIT, B.SHOP_P, final="""
SELECT 'age_group' AS "column", category, code FROM enc_age
UNION ALL SELECT 'payment_method', category, code FROM enc_pm
UNION ALL SELECT 'product_category', category, code FROM enc_pc
UNION ALL SELECT 'device_used', category, code FROM enc_du"""),
    "category_fraud_rates": B.with_(B.SHOP, B.CLEAN_SHOP, B.SHOP_SPLIT, final="""
, t AS (SELECT * FROM shop_split WHERE split = 'train')
SELECT 'payment_method' AS "column", payment_method AS category, count(*) AS n_rows,
       round(avg(is_fraudulent), 6) AS fraud_rate FROM t GROUP BY payment_method
UNION ALL SELECT 'product_category', product_category, count(*), round(avg(is_fraudulent), 6)
          FROM t GROUP BY product_category
UNION ALL SELECT 'device_used', device_used, count(*), round(avg(is_fraudulent), 6) FROM t GROUP BY device_used"""),
    "location_frequency": B.with_(B.SHOP, B.CLEAN_SHOP, B.SHOP_SPLIT, B.SHOP_P, final="""
SELECT category AS customer_location, freq, round(share, 6) AS share FROM enc_loc"""),
    "feature_table_card": _checksums(CARD, "card_f"),
    "feature_table_shop": _checksums(SHOP, "shop_f"),
}

ORACLE.update({
    "feature_rows_card": B.with_(*CARD, final="""
SELECT row_id, split, round(COLUMNS(* EXCLUDE (row_id, split, is_fraudulent)), 6) FROM card_f"""),
    "feature_rows_shop": B.with_(*SHOP, final="""
SELECT row_id, split, COLUMNS(* EXCLUDE (row_id, split, is_fraudulent)) FROM shop_f"""),
})

ORACLE["clean_card_csv"] = ORACLE["clean_card"]  # the same rows, by way of a CSV file
