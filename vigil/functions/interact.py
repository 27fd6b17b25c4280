"""Interaction features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def card_interactions(amt: str, vs: list[str]) -> dict[str, Column]:
    a, h = F.col(amt), F.col("hour")
    out = {"amount_hour_interaction": a * h, "amount_day_interaction": a * F.col("day_of_week")}
    for k, v in enumerate(vs[:10], start=1):
        out[f"amount_v{k}_interaction"] = a * F.col(v)
    for k, v in enumerate(vs[:5], start=1):
        out[f"hour_v{k}_interaction"] = h * F.col(v)
    return out


def shop_interactions(amt: str, cols: set[str]) -> dict[str, Column]:
    a = F.col(amt)
    out: dict[str, Column] = {}
    if "quantity" in cols:
        out["amount_quantity_interaction"] = a * F.col("quantity")
        out["amount_quantity_ratio"] = a / (F.col("quantity") + 1)
    if {"customer_age", "account_age_days"} <= cols:
        out["age_account_interaction"] = F.col("customer_age") * F.col("account_age_days")
        out["age_account_ratio"] = F.col("customer_age") / (F.col("account_age_days") + 1)
    if "hour" in cols:
        out["amount_hour_interaction"] = a * F.col("hour")
        out["amount_day_interaction"] = a * F.col("day_of_week")
    if "age_risk" in cols:
        out["amount_risk_interaction"] = a * F.col("age_risk")
    if {"quantity", "account_age_risk"} <= cols:
        out["quantity_risk_interaction"] = F.col("quantity") * F.col("account_age_risk")
    if {"location_freq", "device_used_encoded"} <= cols:
        out["location_device_interaction"] = F.col("location_freq") * F.col("device_used_encoded")
    if {"payment_method_encoded", "product_category_encoded"} <= cols:
        out["payment_product_interaction"] = F.col("payment_method_encoded") * F.col("product_category_encoded")
    if {"customer_age", "hour"} <= cols:
        out["age_amount_time_interaction"] = F.col("customer_age") * a * F.col("hour")
    if {"account_age_days", "quantity", "location_freq"} <= cols:
        out["account_quantity_location_interaction"] = (
            F.col("account_age_days") * F.col("quantity") * F.col("location_freq"))
    return out
