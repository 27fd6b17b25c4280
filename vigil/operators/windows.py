"""Documented window features (2.P): percentile rank, per-customer time-range
windows, first contact with a merchant, pairwise flags, Yeo-Johnson power
transform.

Time-range windows never put a whole customer into one task: rows are cut into
(customer, time bucket) partitions of ``width / split`` and each row is also
copied, as look-back context only, into the ``split`` following buckets, so
every frame ``(t - width, t]`` is complete inside its own partition. A customer
holding a third of all rows is thus spread over as many tasks as it has
buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.rank import tie_ranks

US = {"1H": 3_600_000_000, "24H": 86_400_000_000, "7D": 7 * 86_400_000_000}


def epoch_us(col: str) -> F.Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def percentile_rank(df: DataFrame, col: str, name: str = "pct_rank") -> DataFrame:
    """Pandas ``rank(pct=True)`` - average rank of ties divided by the count (null and NaN: null)."""
    ranked, n = tie_ranks(df, col, name)
    return ranked.withColumn(name, F.col(name) / F.lit(float(max(n, 1))))


def rolling(df: DataFrame, key: str, ts: str, windows: dict[str, tuple[int, str, str]],
            split: int = 1) -> DataFrame:
    """Half-open time-range windows ``(t - width, t]`` per ``key``.

    ``windows`` maps output name -> (width in microseconds, agg in {count, sum, mean}, value column).
    """
    width = max(w for w, _, _ in windows.values())
    bucket_w = max(1, math.ceil(width / split))
    t = epoch_us(ts)
    base = df.withColumns({"_t": t, "_b": F.floor(t / F.lit(bucket_w)).cast("long")})
    own = base.withColumn("_target", F.lit(True))
    ctx = base.withColumn("_target", F.lit(False)).withColumn(
        "_b", F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + split)))
    both = own.unionByName(ctx)
    w = Window.partitionBy(key, "_b").orderBy("_t")
    cols = {}
    for name, (wid, agg, val) in windows.items():
        frame = w.rangeBetween(-(wid - 1), 0)
        if agg == "count":
            cols[name] = F.count(F.lit(1)).over(frame)
        elif agg == "sum":
            cols[name] = F.sum(F.col(val)).over(frame)
        elif agg == "mean":
            cols[name] = F.avg(F.col(val)).over(frame)
        else:
            raise ValueError(agg)
    return both.withColumns(cols).where("_target").drop("_t", "_b", "_target")


def first_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "is_first") -> DataFrame:
    """1 for the first row of each group in ``order`` (cumcount == 0).

    A grouped minimum (map-side partial aggregation handles hot groups) joined back."""
    first = df.groupBy(*group).agg(F.min(F.struct(*order)).alias("_first"))
    j = df.join(first, list(group), "left")
    return j.withColumn(name, (F.struct(*order) == F.col("_first")).cast("int")).drop("_first")


def pairwise_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """AND of every pair of flags."""
    cols = {}
    for i, a in enumerate(flags):
        for b in flags[i + 1:]:
            cols[f"{a}_and_{b}"] = (F.col(a) * F.col(b)).cast("int")
    return df.withColumns(cols)


# -- Yeo-Johnson (P11) ---------------------------------------------------------

def _yj(x: F.Column, lam: float) -> F.Column:
    pos = (F.pow(x + 1, lam) - 1) / lam if abs(lam) > 1e-12 else F.log1p(x)
    neg = -(F.pow(1 - x, 2 - lam) - 1) / (2 - lam) if abs(lam - 2) > 1e-12 else -F.log1p(-x)
    return F.when(x >= 0, pos).otherwise(neg)


def _loglik(df: DataFrame, col: str, grid: Sequence[float]) -> list[tuple[float, float]]:
    x = F.col(col).cast("double")
    aggs = [F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("s")]
    for i, lam in enumerate(grid):
        y = _yj(x, lam)
        aggs += [F.avg(y).alias(f"m{i}"), F.avg(y * y).alias(f"q{i}")]
    r = df.agg(*aggs).first()
    out = []
    for i, lam in enumerate(grid):
        var = r[f"q{i}"] - r[f"m{i}"] ** 2
        if var is None or var <= 0:
            continue
        out.append((lam, -r["n"] / 2.0 * math.log(var) + (lam - 1) * r["s"]))
    return out


def fit_yeo_johnson(df: DataFrame, col: str, lo: float = -3.0, hi: float = 3.0, steps: int = 61,
                    rounds: int = 3) -> float:
    """Maximum-likelihood lambda: a grid of candidates per aggregate pass, refined around the best."""
    best = 1.0
    for _ in range(rounds):
        grid = [lo + (hi - lo) * i / (steps - 1) for i in range(steps)]
        ll = _loglik(df, col, grid)
        if not ll:
            return best
        best = max(ll, key=lambda t: t[1])[0]
        step = (hi - lo) / (steps - 1)
        lo, hi = best - step, best + step
    return best


def yeo_johnson(df: DataFrame, col: str, lam: float, name: str | None = None,
                standardize: bool = True) -> DataFrame:
    name = name or f"{col}_power"
    out = df.withColumn(name, _yj(F.col(col).cast("double"), lam))
    if standardize:
        r = out.agg(F.avg(name).alias("m"), F.stddev_pop(name).alias("s")).first()
        out = out.withColumn(name, (F.col(name) - F.lit(r["m"])) / F.lit(r["s"] or 1.0))
    return out
