"""Customer features (F1-F12). Lookups (codes, location frequency, category
fraud rates) are joined by the feature model; this module holds the
row-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.exprs import flag

# fixed values: right-closed age bins (0,18], (18,25], (25,35], (35,50], (50,65], (65,100]
AGE_EDGES = [0, 18, 25, 35, 50, 65, 100]
AGE_LABELS = ["teen", "young", "adult", "middle", "senior", "elderly"]
CATEGORICAL = ["payment_method", "product_category", "device_used"]


def age_group(age: Column) -> Column:
    expr = F.when(age.isNull() | (age <= AGE_EDGES[0]) | (age > AGE_EDGES[-1]), F.lit(None).cast("string"))
    for lo, hi, label in zip(AGE_EDGES[:-1], AGE_EDGES[1:], AGE_LABELS):
        expr = expr.when((age > lo) & (age <= hi), F.lit(label))
    return expr


def age_columns() -> dict[str, Column]:
    a = F.col("customer_age")
    return {
        "young_customer": flag(a <= 18),
        "senior_customer": flag(a >= 65),
        "age_risk": F.when(a <= 18, 2).when(a >= 65, 1).otherwise(0),
    }


def account_columns() -> dict[str, Column]:
    d = F.col("account_age_days")
    return {
        "account_age_days_log": F.log1p(d),
        "account_age_weeks": d / 7,
        "account_age_months": d / 30,
        "new_account": flag(d <= 7),
        "recent_account": flag(d <= 30),
        "established_account": flag(d > 90),
        "old_account": flag(d > 365),
        "account_age_risk": F.when(d <= 7, 3).when(d <= 30, 2).when(d <= 90, 1).otherwise(0),
    }
