"""Exact selection: equal to numpy at 1 and many partitions, with one round and with many, and on awkward values."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import select as X

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0]


def lerp(values, probs):
    """Order statistics with linear interpolation, in the engine's form."""
    v, out = sorted(values), []
    for p in probs:
        at = p * (len(v) - 1)
        lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
        out.append(lo if lo == hi or np.floor(at) == np.ceil(at) else lo + (hi - lo) * (at - np.floor(at)))
    return out


def columns(n=4000):
    rng = np.random.default_rng(11)
    heavy = np.exp(rng.normal(0, 150, n)) * rng.choice([-1, 1], n)     # over all scales of doubles
    tied = np.where(rng.random(n) < 0.4, 7.25, rng.random(n))          # a capped value
    close = 1e15 + rng.integers(0, 50, n) / 8                          # apart by few ulps
    ends = np.where(rng.random(n) < 0.3, np.inf, rng.normal(size=n))
    outlier = np.append(rng.random(n - 1), 1.7e308)
    return {"normal": rng.normal(size=n), "heavy": heavy, "tied": tied, "close": close, "ends": ends, "outlier": outlier,
            "whole": rng.integers(-5, 5, n).astype(float), "tiny": rng.random(n) * 5e-320}


@pytest.mark.parametrize("few,buckets,parts", [(1 << 14, 4096, 1), (16, 4096, 7), (1, 4, 3)])
def test_quantiles_are_those_of_numpy(spark, monkeypatch, few, buckets, parts):
    monkeypatch.setattr(X, "FEW", few)
    monkeypatch.setattr(X, "BUCKETS", buckets)
    data = columns(4000 if buckets > 4 else 300)
    names = list(data) if buckets > 4 else ["normal", "tied", "close", "whole"]
    rows = [tuple(map(float, r)) for r in zip(*(data[c] for c in names))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(parts)
    got = X.exact_quantiles(df, names, PROBS)[()]
    for c in names:
        assert got[c] == lerp(data[c].tolist(), PROBS), c


def test_groups_without_a_cap(spark, monkeypatch):
    monkeypatch.setattr(X, "FEW", 8)
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)  # groups are joined
    rng = np.random.default_rng(3)
    rows = [(None if g == 0 else int(g), float(x), None if x < 0.1 else float(x)) for g, x in zip(rng.integers(0, 40, 6000) ** 2 // 40, rng.random(6000))]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    got = X.exact_quantiles(df, ["x", "y"], [0.5, 0.95], by=["g"], extra={"n": F.count("y")})
    assert set(got) == {(r[0],) for r in rows}
    for (g,), q in got.items():
        assert q["x"] == lerp([r[1] for r in rows if r[0] == g], [0.5, 0.95])
        ys = [r[2] for r in rows if r[0] == g and r[2] is not None]
        assert q["y"] == lerp(ys, [0.5, 0.95]) and q["extra"]["n"] == len(ys)


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0), (None, None)], "x double, y double")
    assert X.exact_quantiles(df, ["x", "y"], [0.5]) == {(): {"x": [None], "y": [2.0]}}
    assert X.exact_quantiles(df.limit(0), ["x"], [0.5, 1.0], extra={"n": F.count(F.lit(1))})[()] == {"x": [None, None], "extra": {"n": 0}}
    assert X.rows_at(df.limit(0).select("y"), ["y"], lambda n: [0]) == (0, {})


@pytest.mark.parametrize("few", [1 << 14, 4])
def test_rows_at_positions_of_several_keys(spark, monkeypatch, few):
    monkeypatch.setattr(X, "FEW", few)
    rng = np.random.default_rng(5)
    start = dt.datetime(2023, 1, 1)
    rows = [(start + dt.timedelta(microseconds=int(rng.integers(0, 5)) if i % 3 else 17), int(rng.integers(-3, 3)), 2**62 - i * 2**51) for i in range(3000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, a int, b long").repartition(5)
    at = [0, 1, 999, 1000, 1001, 2400, 2999]
    n, got = X.rows_at(df, ["t", "a", "b"], lambda n: [*at, n, n + 5, -1])
    want = sorted(rows)
    assert n == 3000 and got == {p: want[p] for p in at}


def test_selection_plan_has_no_sort_of_the_rows(spark):
    df = spark.range(0, 200_000).select(F.xxhash64("id").cast("double").alias("x"), F.lit(0).alias("c"), F.struct(F.lit(0).alias("all")).alias("g"))
    state = df.groupBy("g", "c").agg(F.count("x").alias("total"), F.min("x").alias("lo"), F.max("x").alias("hi")).withColumn("pos", F.array(F.lit(77).cast("long")))
    plan = X.values_at(df, state)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan and "MapIn" not in plan
