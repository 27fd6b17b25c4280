"""Behavioural (G1-G8) and velocity (H1-H4) features of the shop shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.exprs import flag


def behavior_columns(amt: str, p: dict) -> dict[str, Column]:
    q, d, a = F.col("quantity"), F.col("account_age_days"), F.col(amt)
    hvlq = flag((a > F.lit(p["amount_90"])) & (q <= 1))
    lvhq = flag((a < F.lit(p["amount_50"])) & (q > F.lit(p["quantity_90"])))
    return {
        "quantity_log": F.log1p(q),
        "quantity_per_day": q / (d + 1),
        "quantity_scaled": (q - F.lit(p["quantity_center"])) / F.lit(p["quantity_scale"]),
        "quantity_above_75": flag(q > F.lit(p["quantity_75"])),
        "quantity_above_90": flag(q > F.lit(p["quantity_90"])),
        "quantity_above_95": flag(q > F.lit(p["quantity_95"])),
        "high_value_low_quantity": hvlq,
        "low_value_high_quantity": lvhq,
        "avg_amount_per_item": a / (q + 1),
        "purchase_efficiency": a / (q * d + 1),
        "unusual_purchase_pattern": flag((hvlq == 1) | (lvhq == 1)),
    }


def velocity_columns(amt: str, p: dict) -> dict[str, Column]:
    q, d, a = F.col("quantity"), F.col("account_age_days"), F.col(amt)
    hav = flag(a / (d + 1) > F.lit(p["amount_95"]))
    hqv = flag(q / (d + 1) > F.lit(p["quantity_95"]))
    return {
        "transaction_velocity": F.lit(1.0) / (d + 1),
        "amount_velocity": a / (d + 1),
        "quantity_velocity": q / (d + 1),
        "amount_per_transaction": a,
        "quantity_per_transaction": q,
        "high_amount_velocity": hav,
        "high_quantity_velocity": hqv,
        "velocity_risk_score": hav * 2.0 + hqv * 1.5 + F.col("new_account") * 2.0,
    }
