"""Risk flags and composite scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.exprs import EPS, flag

# fixed values: weights of the card composite score
CARD_WEIGHTS = [
    ("amount_above_95", 3), ("is_late_night", 2), ("amount_outlier", 3), ("high_risk_combination", 4),
    ("suspicious_time_pattern", 3), ("weekend_high_value", 2.5), ("rush_hour_high_value", 2.5),
    ("v_features_outlier", 3), ("high_v_features_risk", 4),
]
# fixed values: weights of the shop composite score
SHOP_WEIGHTS = [
    ("amount_above_95", 3), ("is_late_night", 2), ("new_account", 3), ("young_customer", 2),
    ("rare_location", 2), ("quantity_above_95", 2), ("high_risk_combination", 4),
    ("new_account_high_amount", 4), ("young_customer_high_amount", 3), ("rare_location_high_amount", 3),
    ("unusual_purchase_pattern", 2), ("velocity_risk_score", 2), ("suspicious_time_pattern", 3),
    ("weekend_high_value", 2.5), ("high_risk_device", 3), ("high_risk_payment", 3), ("high_risk_product", 3),
    ("unusual_amount_pattern", 4), ("velocity_anomaly", 4), ("high_risk_customer_profile", 4),
    ("foreign_high_value", 3.5), ("rush_hour_high_value", 2.5), ("multi_risk_pattern", 5),
    ("sophisticated_fraud_pattern", 6),
]
CATEGORY_RISK_RATE = 0.1
LOCATION_RISK_SHARE = 0.05


def _weighted(terms) -> Column:
    return sum((F.col(n).cast("double") * float(w) for n, w in terms), F.lit(0.0))


def bands() -> dict[str, Column]:
    s = F.col("comprehensive_risk_score")
    return {"low_risk": flag(s <= 2), "medium_risk": flag((s > 2) & (s <= 6)), "high_risk": flag(s > 6)}


def card_risk_first(amt: str, p: dict, vs: list[str], batch: dict[str, Column]) -> dict[str, Column]:
    """J1-J8 of the card shape. ``batch`` holds per-batch mean/std columns of each v."""
    a = F.col(amt)
    z = (a - F.lit(p["amount_50"])) / F.lit(p["amount_75"] - p["amount_50"] + EPS)
    out = {
        "high_risk_combination": flag((a > F.lit(p["amount_95"])) & (F.col("is_late_night") == 1)),
        "suspicious_time_pattern": flag((F.col("is_high_risk_hour") == 1) & (a > F.lit(p["amount_75"]))),
        "weekend_high_value": flag((F.col("is_weekend") == 1) & (a > F.lit(p["amount_90"]))),
        "amount_z_score": z,
        "amount_outlier": flag(F.abs(z) > 2),
    }
    if vs:
        anyout = None
        for v in vs:
            cond = F.coalesce(F.abs(F.col(v) - batch[f"mean_{v}"]) > batch[f"std_{v}"] * 2, F.lit(False))
            anyout = cond if anyout is None else anyout | cond
        out["v_features_outlier"] = flag(anyout)
        out["high_v_features_risk"] = flag((out["v_features_outlier"] == 1) & (a > F.lit(p["amount_75"])))
    out["rush_hour_high_value"] = flag((F.col("is_rush_hour") == 1) & (a > F.lit(p["amount_90"])))
    return out


def card_score(vs: list[str], batch: dict[str, Column]) -> Column:
    terms = [t for t in CARD_WEIGHTS if vs or not t[0].startswith(("v_", "high_v"))]
    score = _weighted(terms)
    if vs:
        score = score + flag(F.col("v_features_mean") > batch["q95_v_mean"]) * 2.0
        score = score + flag(F.col("v_features_std") > batch["q95_v_std"]) * 2.0
    return score


def shop_risk(amt: str, p: dict) -> dict[str, Column]:
    a = F.col(amt)
    above = {q: a > F.lit(p[f"amount_{q}"]) for q in (75, 90, 95)}
    az = (a - F.lit(p["amount_50"])) / F.lit(p["amount_75"] - p["amount_50"] + EPS)
    qz = (F.col("quantity") - F.lit(p["quantity_50"])) / F.lit(p["quantity_75"] - p["quantity_50"] + EPS)
    ao, qo = flag(F.abs(az) > 2), flag(F.abs(qz) > 2)
    return {
        "high_risk_combination": flag(above[95] & (F.col("is_late_night") == 1)),
        "new_account_high_amount": flag((F.col("new_account") == 1) & above[90]),
        "young_customer_high_amount": flag((F.col("young_customer") == 1) & above[75]),
        "rare_location_high_amount": flag((F.col("rare_location") == 1) & above[75]),
        "suspicious_time_pattern": flag((F.col("is_high_risk_hour") == 1) & above[75]),
        "weekend_high_value": flag((F.col("is_weekend") == 1) & above[90]),
        "high_risk_device": flag((F.col("device_used_fraud_rate") > CATEGORY_RISK_RATE) & above[75]),
        "high_risk_payment": flag((F.col("payment_method_fraud_rate") > CATEGORY_RISK_RATE) & above[75]),
        "high_risk_product": flag((F.col("product_category_fraud_rate") > CATEGORY_RISK_RATE) & above[75]),
        "amount_z_score": az,
        "quantity_z_score": qz,
        "amount_outlier": ao,
        "quantity_outlier": qo,
        "unusual_amount_pattern": flag((ao == 1) & (qo == 1)),
        "velocity_anomaly": flag((F.col("velocity_risk_score") > 3) & above[75]),
        "high_risk_customer_profile": flag((F.col("age_risk") > 0) & (F.col("account_age_risk") > 1) & above[75]),
        "foreign_high_value": flag((F.col("location_risk_score") > LOCATION_RISK_SHARE) & above[90]),
        "rush_hour_high_value": flag((F.col("is_rush_hour") == 1) & above[90]),
        "multi_risk_pattern": flag((F.col("new_account") == 1) & (F.col("is_late_night") == 1) & above[90]),
        "sophisticated_fraud_pattern": flag((F.col("young_customer") == 1) & (F.col("rare_location") == 1)
                                            & (F.col("is_high_risk_hour") == 1) & above[75]),
    }


def shop_score() -> Column:
    return _weighted(SHOP_WEIGHTS)
