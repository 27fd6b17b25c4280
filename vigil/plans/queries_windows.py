"""Driver queries for the documented window features (2.P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import windows as W
from vigil.plans import prepare as P
from vigil.plans.common import rounded
from vigil.sources.fixtures import shop
from vigil.sources.tables import read_table

HIGH_VALUE_PCT = 0.95
BURST_COUNT = 10
PAIR_FLAGS = ["is_late_night", "amount_above_95", "new_account_30", "is_weekend"]


def _events(spark, sf):
    return read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


def q_percentile_rank(spark, sf):
    df = W.percentile_rank(P.clean_card(spark, sf).select("row_id", "amount"), "amount")
    return rounded(df.select("row_id", "pct_rank",
                             (F.col("pct_rank") > HIGH_VALUE_PCT).cast("int").alias("high_value")))


def q_moving_mean_7d(spark, sf):
    r = W.rolling(_events(spark, sf), "user_id", "ts", {"mean_7d": (W.US["7D"], "mean", "value")})
    return rounded(r.select("event_id", "user_id", "mean_7d"))


def q_tx_count_1h(spark, sf):
    r = W.rolling(_events(spark, sf), "user_id", "ts", {"tx_count_1h": (W.US["1H"], "count", "value")})
    return r.select("event_id", "user_id", "tx_count_1h")


def q_velocity_windows(spark, sf):
    spec = {}
    for label in ("1H", "24H", "7D"):
        tag = label.lower()
        spec[f"count_{tag}"] = (W.US[label], "count", "value")
        spec[f"sum_{tag}"] = (W.US[label], "sum", "value")
        spec[f"mean_{tag}"] = (W.US[label], "mean", "value")
    r = W.rolling(_events(spark, sf), "user_id", "ts", spec, split=7)
    return rounded(r.select("event_id", *spec))


def q_suspicious_pattern(spark, sf):
    ev = _events(spark, sf)
    ev = W.rolling(ev, "user_id", "ts", {"tx_count_1h": (W.US["1H"], "count", "value")})
    ev = W.percentile_rank(ev, "value", "value_pct")
    h = F.hour("ts")
    out = ev.select("event_id", ((h >= 23) | (h <= 6)).cast("int").alias("is_late_night"),
                    (F.col("value_pct") > HIGH_VALUE_PCT).cast("int").alias("high_value"), "tx_count_1h")
    return out.withColumn("suspicious", (((F.col("is_late_night") == 1) & (F.col("high_value") == 1))
                                         | (F.col("tx_count_1h") > BURST_COUNT)).cast("int"))


def q_first_merchant_tx(spark, sf):
    df = shop(spark, sf, keep_keys=True, with_customer=True)
    order = ["transaction_date", "l_orderkey", "l_linenumber", "l_partkey", "quantity", "l_extendedprice"]
    r = W.first_in_group(df, ["customer_id", "l_suppkey"], order, "is_first")
    return rounded(r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity",
                            "l_extendedprice", "customer_id", "is_first"))


def q_flag_pairs(spark, sf):
    ft = P.shop_features(spark, sf)[1]
    ft = ft.withColumn("new_account_30", (F.col("account_age_days") < 30).cast("int"))
    r = W.pairwise_flags(ft.select("row_id", *PAIR_FLAGS), PAIR_FLAGS)
    return r.drop(*PAIR_FLAGS)


def q_power_transform(spark, sf):
    df = P.clean_card(spark, sf).select("row_id", "amount")
    lam = W.fit_yeo_johnson(df, "amount")
    return rounded(W.yeo_johnson(df, "amount", lam).withColumn("lambda", F.lit(lam)))


QUERIES = {
    "percentile_rank": q_percentile_rank, "moving_mean_7d": q_moving_mean_7d, "tx_count_1h": q_tx_count_1h,
    "velocity_windows": q_velocity_windows, "suspicious_pattern": q_suspicious_pattern,
    "first_merchant_tx": q_first_merchant_tx, "flag_pairs": q_flag_pairs, "power_transform": q_power_transform,
}
