"""Amount features (D1-D10). ``amt`` is a parameter (card ``amount``, shop
``transaction_amount``); thresholds come from the fitted parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.exprs import EPS, flag

THRESHOLDS = (50, 75, 90, 95)  # fixed values: fitted amount percentiles


def amount_columns(amt: str, p: dict) -> dict[str, Column]:
    a = F.col(amt)
    out = {
        "amount_log": F.log1p(a),
        "amount_sqrt": F.sqrt(a),
        "amount_scaled": (a - F.lit(p["amount_center"])) / F.lit(p["amount_scale"]),
    }
    for q in THRESHOLDS:
        out[f"amount_above_{q}"] = flag(a > F.lit(p[f"amount_{q}"]))
    out["amount_ratio_to_median"] = a / F.lit(p["amount_50"] + EPS)
    out["amount_ratio_to_95th"] = a / F.lit(p["amount_95"] + EPS)
    out["amount_volatility"] = F.abs(a - F.lit(p["amount_50"])) / F.lit(p["amount_50"] + EPS)
    return out


def v_stat_columns(vs: list[str]) -> dict[str, Column]:
    """Row-wise statistics across the present v columns; nulls skipped, std ddof=1."""
    cnt = sum((F.col(v).isNotNull().cast("int") for v in vs), F.lit(0))
    total = sum((F.coalesce(F.col(v), F.lit(0.0)) for v in vs), F.lit(0.0))
    abs_total = sum((F.coalesce(F.abs(F.col(v)), F.lit(0.0)) for v in vs), F.lit(0.0))
    return {
        "_v_cnt": cnt,
        "v_features_mean": F.try_divide(total, cnt),
        "v_features_abs_mean": F.try_divide(abs_total, cnt),
        "v_features_max": F.greatest(*[F.col(v) for v in vs]) if len(vs) > 1 else F.col(vs[0]),
        "v_features_min": F.least(*[F.col(v) for v in vs]) if len(vs) > 1 else F.col(vs[0]),
    }


def v_std_column(vs: list[str]) -> Column:
    mean = F.col("v_features_mean")
    ss = sum((F.coalesce(F.pow(F.col(v) - mean, 2), F.lit(0.0)) for v in vs), F.lit(0.0))
    return F.sqrt(F.try_divide(ss, F.col("_v_cnt") - 1))


V_ORDER = ["v_features_mean", "v_features_std", "v_features_max", "v_features_min", "v_features_range",
           "v_features_abs_mean", "amount_v_mean_interaction", "amount_v_std_interaction"]
