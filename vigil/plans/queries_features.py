"""Driver queries over cleaning, splits and the feature blocks (2.A-2.K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import split as S
from vigil.operators.checksums import CHECKSUMS, checksum_states
from vigil.operators.quality import wide_stats
from vigil.plans import prepare as P
from vigil.plans.common import epoch_us, rounded

AMOUNT_COLS = ["amount_log", "amount_sqrt", "amount_scaled", "amount_above_50", "amount_above_75",
               "amount_above_90", "amount_above_95", "amount_ratio_to_median", "amount_ratio_to_95th",
               "amount_volatility"]
V_STAT_COLS = ["v_features_mean", "v_features_std", "v_features_max", "v_features_min", "v_features_range",
               "v_features_abs_mean", "amount_v_mean_interaction", "amount_v_std_interaction"]
TEMPORAL_COLS = ["hour", "day_of_week", "day_of_month", "month", "quarter", "is_weekend", "is_late_night",
                 "is_business_hours", "is_rush_hour", "hour_sin", "hour_cos", "day_sin", "day_cos",
                 "month_sin", "month_cos", "is_high_risk_hour", "is_holiday_period"]
CUSTOMER_COLS = ["age_group_encoded", "young_customer", "senior_customer", "age_risk", "account_age_days_log",
                 "account_age_weeks", "account_age_months", "new_account", "recent_account",
                 "established_account", "old_account", "account_age_risk", "location_freq",
                 "location_risk_score", "rare_location", "payment_method_encoded", "payment_method_fraud_rate",
                 "product_category_encoded", "product_category_fraud_rate", "device_used_encoded",
                 "device_used_fraud_rate"]
BEHAVIOR_COLS = ["quantity_log", "quantity_per_day", "quantity_scaled", "quantity_above_75", "quantity_above_90",
                 "quantity_above_95", "high_value_low_quantity", "low_value_high_quantity",
                 "avg_amount_per_item", "purchase_efficiency", "unusual_purchase_pattern"]
VELOCITY_COLS = ["transaction_velocity", "amount_velocity", "quantity_velocity", "amount_per_transaction",
                 "quantity_per_transaction", "high_amount_velocity", "high_quantity_velocity",
                 "velocity_risk_score"]
CARD_INTER_COLS = (["amount_hour_interaction", "amount_day_interaction"]
                   + [f"amount_v{k}_interaction" for k in range(1, 11)]
                   + [f"hour_v{k}_interaction" for k in range(1, 6)])
SHOP_INTER_COLS = ["amount_quantity_interaction", "amount_quantity_ratio", "age_account_interaction",
                   "age_account_ratio", "amount_hour_interaction", "amount_day_interaction",
                   "amount_risk_interaction", "quantity_risk_interaction", "location_device_interaction",
                   "payment_product_interaction", "age_amount_time_interaction",
                   "account_quantity_location_interaction"]
CARD_RISK_COLS = ["high_risk_combination", "suspicious_time_pattern", "weekend_high_value", "amount_z_score",
                  "amount_outlier", "v_features_outlier", "high_v_features_risk", "rush_hour_high_value",
                  "comprehensive_risk_score", "low_risk", "medium_risk", "high_risk"]
SHOP_RISK_COLS = ["high_risk_combination", "new_account_high_amount", "young_customer_high_amount",
                  "rare_location_high_amount", "suspicious_time_pattern", "weekend_high_value",
                  "high_risk_device", "high_risk_payment", "high_risk_product", "amount_z_score",
                  "quantity_z_score", "amount_outlier", "quantity_outlier", "unusual_amount_pattern",
                  "velocity_anomaly", "high_risk_customer_profile", "foreign_high_value", "rush_hour_high_value",
                  "multi_risk_pattern", "sophisticated_fraud_pattern", "comprehensive_risk_score", "low_risk",
                  "medium_risk", "high_risk"]


def q_clean_card(spark, sf):
    df = P.clean_card(spark, sf)
    return rounded(df.select("row_id", "time", "amount", epoch_us("transaction_date").alias("transaction_us"),
                             "transaction_hour", "is_fraudulent"))


def q_clean_shop(spark, sf):
    df = P.clean_shop(spark, sf)
    return rounded(df.select("row_id", epoch_us("transaction_date").alias("transaction_us"),
                             "transaction_amount", "quantity", "customer_age", "account_age_days",
                             "customer_location", "payment_method", "product_category", "device_used",
                             "is_fraudulent", "transaction_hour"))


def q_split_80_10_10(spark, sf):
    return P.card_split(spark, sf, "80_10_10").select("row_id", "split")


def q_split_80_20(spark, sf):
    return P.card_split(spark, sf, "80_20").select("row_id", "split")


def q_split_90_10(spark, sf):
    return P.shop_split(spark, sf, "90_10").select("row_id", "split")


def q_split_report(spark, sf):
    df = P.card_split(spark, sf, "80_10_10")
    n = F.count(F.lit(1))
    rep = df.groupBy("split").agg(n.alias("n_rows"), F.sum("is_fraudulent").cast("long").alias("positives"),
                                  F.avg("is_fraudulent").alias("fraud_rate"))
    total = df.count()
    return rounded(rep.withColumn("fraction", F.col("n_rows") / F.lit(total)))


def q_tail_validation_rows(spark, sf):
    df = P.card_split(spark, sf, "80_20")
    normal = df.where((F.col("split") == "train") & (F.col("is_fraudulent") == 0))
    return S.tail_rows(normal, 0.2).select("row_id", "is_tail")


def _card_ft(spark, sf):
    return P.card_features(spark, sf)[1]


def _shop_ft(spark, sf):
    return P.shop_features(spark, sf)[1]


def _subset(ft, cols):
    return rounded(ft.select("row_id", "split", *cols))


def q_amount_features(spark, sf):
    return _subset(_card_ft(spark, sf), AMOUNT_COLS)


def q_v_statistics(spark, sf):
    return _subset(_card_ft(spark, sf), V_STAT_COLS)


def q_temporal_features(spark, sf):
    return _subset(_card_ft(spark, sf), TEMPORAL_COLS)


def q_hour_deviation(spark, sf):
    return _subset(_shop_ft(spark, sf), ["hour", "hour_deviation"])


def q_customer_features(spark, sf):
    return _subset(_shop_ft(spark, sf), CUSTOMER_COLS)


def q_behavior_features(spark, sf):
    return _shop_ft(spark, sf).select("row_id", "split", *BEHAVIOR_COLS)  # not rounded: a tie would round differently per engine


def q_velocity_features(spark, sf):
    return _shop_ft(spark, sf).select("row_id", "split", *VELOCITY_COLS)


def q_interactions_card(spark, sf):
    return _subset(_card_ft(spark, sf), CARD_INTER_COLS)


def q_interactions_shop(spark, sf):
    return _subset(_shop_ft(spark, sf), SHOP_INTER_COLS)


def q_risk_flags_card(spark, sf):
    return _subset(_card_ft(spark, sf), CARD_RISK_COLS)


def q_risk_flags_shop(spark, sf):
    return _subset(_shop_ft(spark, sf), SHOP_RISK_COLS)


def q_risk_bands(spark, sf):
    card = _card_ft(spark, sf).select(F.lit("card").alias("shape"), "split", "low_risk", "medium_risk",
                                      "high_risk", "comprehensive_risk_score")
    shop = _shop_ft(spark, sf).select(F.lit("shop").alias("shape"), "split", "low_risk", "medium_risk",
                                      "high_risk", "comprehensive_risk_score")
    both = card.unionByName(shop)
    return rounded(both.groupBy("shape", "split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("low_risk").cast("long").alias("n_low"), F.sum("medium_risk").cast("long").alias("n_medium"),
        F.sum("high_risk").cast("long").alias("n_high"),
        F.avg("comprehensive_risk_score").alias("mean_score"),
        F.max("comprehensive_risk_score").alias("max_score")))


def _encodings(spark, sf):
    return P.fit_features(P.shop_split(spark, sf), held=True).encodings


def q_label_codes(spark, sf):
    enc = _encodings(spark, sf)
    return enc.where(F.col("column").isin("age_group", "payment_method", "product_category", "device_used")) \
        .select("column", "category", "code")


def q_category_fraud_rates(spark, sf):
    enc = _encodings(spark, sf)
    return rounded(enc.where(F.col("column").isin("payment_method", "product_category", "device_used"))
                   .select("column", "category", F.col("freq").alias("n_rows"), "fraud_rate"))


def q_location_frequency(spark, sf):
    enc = _encodings(spark, sf)
    return rounded(enc.where(F.col("column") == "customer_location")
                   .select(F.col("category").alias("customer_location"), "freq", "share"))


def _checksums(ft, keys=("row_id", "split", "is_fraudulent")):
    """Per (feature, split): exact total (decimal sum of values rounded to 6 places), non-zero count, min, max."""
    feats = [c for c in ft.columns if c not in keys]
    return wide_stats(ft, feats, CHECKSUMS, by=["split"], states=checksum_states)


def q_feature_table_card(spark, sf):
    return _checksums(_card_ft(spark, sf))


def q_feature_table_shop(spark, sf):
    return _checksums(_shop_ft(spark, sf))


QUERIES = {
    "clean_card": q_clean_card, "clean_shop": q_clean_shop,
    "split_80_10_10": q_split_80_10_10, "split_80_20": q_split_80_20, "split_90_10": q_split_90_10,
    "split_report": q_split_report, "tail_validation_rows": q_tail_validation_rows,
    "amount_features": q_amount_features, "v_statistics": q_v_statistics,
    "temporal_features": q_temporal_features, "hour_deviation": q_hour_deviation,
    "customer_features": q_customer_features, "label_codes": q_label_codes,
    "category_fraud_rates": q_category_fraud_rates, "location_frequency": q_location_frequency,
    "behavior_features": q_behavior_features, "velocity_features": q_velocity_features,
    "interactions_card": q_interactions_card, "interactions_shop": q_interactions_shop,
    "risk_flags_card": q_risk_flags_card, "risk_flags_shop": q_risk_flags_shop, "risk_bands": q_risk_bands,
    "feature_table_card": q_feature_table_card, "feature_table_shop": q_feature_table_shop,
}


def q_feature_rows_card(spark, sf):
    """The full 96-feature card table (every split, per-split batch statistics)."""
    return rounded(_card_ft(spark, sf).drop("is_fraudulent"))


def q_feature_rows_shop(spark, sf):
    """The full 109-feature shop table."""
    return _shop_ft(spark, sf).drop("is_fraudulent")


QUERIES.update({"feature_rows_card": q_feature_rows_card, "feature_rows_shop": q_feature_rows_shop})
