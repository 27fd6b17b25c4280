"""Cleaning (B1-B12): column names, target rename, abs, winsorising, clipping,
calendar axis, identifier drop. Whole-table statistics (the p99 caps and the
time maximum) come from one aggregate pass and enter the projection as
literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import clip_range, clip_upper, nan_to_null
from vigil.operators.select import exact_quantiles

# fixed values: cleaning constants of the reference
V_COLUMNS = [f"v{i}" for i in range(1, 29)]
ID_COLUMNS = ["transaction_id", "customer_id", "ip_address", "shipping_address", "billing_address"]
CARD_BASE_DATE = "2023-01-01 00:00:00"
SIX_MONTHS_SECONDS = 6 * 30 * 24 * 3600
AGE_BOUNDS = (13, 100)
ACCOUNT_AGE_MAX = 3650
CAP_QUANTILE = 0.99


def normalise_names(df: DataFrame) -> DataFrame:
    """B1: lower-case, spaces to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def is_card(df: DataFrame) -> bool:
    """Card shape when any v column is present (plan-time check)."""
    return any(v in df.columns for v in V_COLUMNS)


def missing_v_columns(df: DataFrame) -> list[str]:
    """Expected v columns that are absent."""
    return [v for v in V_COLUMNS if v not in df.columns]


def _caps(df: DataFrame, cols: list[str], held: bool) -> dict[str, float]:
    q = exact_quantiles(df.select(*[F.abs(nan_to_null(F.col(c).cast("double"))).alias(c) for c in cols]),
                        cols, [CAP_QUANTILE], held=held)
    return {c: q.get((), {}).get(c, [None])[0] for c in cols}


def clean(df: DataFrame, params: dict | None = None, held: bool = False) -> DataFrame:
    """Clean a raw card or shop table (B1-B10); ``held``: the caller holds it in memory or on disk."""
    df = normalise_names(df)
    if "class" in df.columns:
        return _clean_card(df.withColumnRenamed("class", "is_fraudulent"), params)
    if "v1" in df.columns and "is_fraudulent" in df.columns:
        return _clean_card(df, params)
    return _clean_shop(df, held)


def card_date(time_col, max_time) -> "F.Column":
    """``base + time / max(time) * 6 months``, whole microseconds; null if max is 0."""
    micros = F.round(F.try_divide(time_col.cast("double"), F.lit(float(max_time) if max_time is not None else None))
                     * F.lit(float(SIX_MONTHS_SECONDS)) * F.lit(1_000_000.0)).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.expr(f"TIMESTAMP_NTZ'{CARD_BASE_DATE}'"))


def event_time(df: DataFrame) -> DataFrame:
    """``transaction_date`` = base date + ``time`` seconds (whole microseconds), where the column is missing.

    A null or NaN time gives a null date; a table that has dates, or no ``time``, is left as it is."""
    if "transaction_date" in df.columns or "time" not in df.columns:
        return df
    micros = F.round(nan_to_null(F.col("time").cast("double")) * 1_000_000).cast("long")
    return df.withColumn("transaction_date", F.timestamp_add("MICROSECOND", micros, F.expr(f"TIMESTAMP_NTZ'{CARD_BASE_DATE}'")))


def card_clean_params(df: DataFrame) -> dict:
    """Whole-table statistics of the card cleaning step (p99 cap, time maximum), one pass."""
    out = {}
    extra = {"max_time": F.max("time")} if "time" in df.columns else {}
    if "amount" in df.columns:
        src = df.select(F.abs(nan_to_null(F.col("amount").cast("double"))).alias("amount"),
                        *([F.col("time")] if extra else []))
        q = exact_quantiles(src, ["amount"], [CAP_QUANTILE], extra=extra)[()]
        out["amount_cap"] = q["amount"][0]
        out.update(q.get("extra", {}))
    elif extra:
        out["max_time"] = df.agg(F.max("time")).first()[0]
    return out


def _clean_card(df: DataFrame, params: dict | None = None) -> DataFrame:
    """B3, B4, B6, B9 for the card shape; ``params`` fixes the statistics (streams)."""
    params = params if params is not None else card_clean_params(df)
    out = {}
    if "amount" in df.columns:
        cap = params.get("amount_cap")
        a = F.abs(nan_to_null(F.col("amount").cast("double")))
        out["amount"] = clip_upper(a, cap) if cap is not None else a
    if "time" in df.columns:
        out["transaction_date"] = card_date(F.col("time"), params.get("max_time"))
    df = df.withColumns(out)
    if "transaction_date" in out:
        df = df.withColumn("transaction_hour", F.hour("transaction_date"))
    return df


def _clean_shop(df: DataFrame, held: bool) -> DataFrame:
    out = {}
    if "transaction_date" in df.columns:
        out["transaction_date"] = F.col("transaction_date").cast("timestamp_ntz")
    capped = [c for c in ("transaction_amount", "quantity") if c in df.columns]
    caps = _caps(df, capped, held) if capped else {}
    for c in capped:
        a = F.abs(nan_to_null(F.col(c).cast("double")))
        out[c] = clip_upper(a, caps[c]) if caps[c] is not None else a
    if "customer_age" in df.columns:
        out["customer_age"] = clip_range(F.col("customer_age"), *AGE_BOUNDS)
    if "account_age_days" in df.columns:
        out["account_age_days"] = clip_upper(F.abs(F.col("account_age_days")), ACCOUNT_AGE_MAX)
    df = df.withColumns(out)
    if "transaction_date" in df.columns:
        df = df.withColumn("transaction_hour", F.hour("transaction_date"))
    return df.drop(*[c for c in ID_COLUMNS if c in df.columns])
