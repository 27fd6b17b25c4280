"""Calendar features (E1-E12) on a TIMESTAMP_NTZ column (session time zone does not matter)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.exprs import EPS, TWO_PI, flag

# fixed values: default hour bands of the coded feature set
LATE_NIGHT = (23, 6)       # hour >= 23 or hour <= 6
BUSINESS_HOURS = (9, 17)   # inclusive
RUSH_HOURS = ((7, 9), (17, 19))
HIGH_RISK_HOURS = (0, 4)
HOLIDAY_MONTHS = (12, 1)


def temporal_columns(ts: str, p: dict, late_night=LATE_NIGHT, business_hours=BUSINESS_HOURS,
                     business_weekdays_only: bool = False) -> dict[str, Column]:
    t = F.col(ts)
    h, dow, m = F.hour(t), F.weekday(t), F.month(t)   # weekday: Monday = 0
    business = h.between(*business_hours)
    if business_weekdays_only:
        business = business & (dow < 5)
    return {
        "hour": h,
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(t),
        "month": m,
        "quarter": F.quarter(t),
        "is_weekend": flag(dow >= 5),
        "is_late_night": flag((h >= late_night[0]) | (h <= late_night[1])),
        "is_business_hours": flag(business),
        "is_rush_hour": flag(h.between(*RUSH_HOURS[0]) | h.between(*RUSH_HOURS[1])),
        "hour_sin": F.sin(F.lit(TWO_PI) * h / 24),
        "hour_cos": F.cos(F.lit(TWO_PI) * h / 24),
        "day_sin": F.sin(F.lit(TWO_PI) * dow / 7),
        "day_cos": F.cos(F.lit(TWO_PI) * dow / 7),
        "month_sin": F.sin(F.lit(TWO_PI) * m / 12),
        "month_cos": F.cos(F.lit(TWO_PI) * m / 12),
        "is_high_risk_hour": flag(h.between(*HIGH_RISK_HOURS)),
        "is_holiday_period": flag(m.isin(*HOLIDAY_MONTHS)),
        "hour_deviation": F.abs(h - F.lit(p["hour_mean"])) / F.lit((p["hour_std"] or 0.0) + EPS)
        if p.get("hour_mean") is not None else F.lit(None).cast("double"),
    }
