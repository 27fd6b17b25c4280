"""Small Column helpers shared by the feature blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi
EPS = 1e-8  # fixed value: the reference's guard added to denominators


def c(name: str) -> Column:
    return F.col(name)


def lit(v) -> Column:
    return F.lit(v)


def flag(cond: Column) -> Column:
    """0/1 INT; a null comparison counts as false (as NaN comparisons do in pandas)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def dbl(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def clip_upper(col: Column, upper) -> Column:
    """Null-preserving ``min(col, upper)`` (``least`` would skip a null)."""
    return F.when(col > upper, F.lit(upper)).otherwise(col)


def clip_range(col: Column, lower, upper) -> Column:
    return (F.when(col < lower, F.lit(lower)).when(col > upper, F.lit(upper)).otherwise(col))


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))
