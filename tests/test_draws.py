"""Seeded draws, fingerprints and neighbour checks against single-node brute force."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators import fingerprint as FP
from vigil.operators.draws import permuted, round_keys
from vigil.operators.quality import order_violations
from vigil.operators.rank import tie_ranks
from vigil.operators.split import random_split, sample_exact, shuffle_labels
from vigil.operators.windows import percentile_rank


def _number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _image(x, n, seed):
    for r, k in enumerate(round_keys(n, seed)):
        other = (k - x) % n
        x = other if _number(f"{seed}:{r}:{max(x, other)}") % 2 else x
    return x


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_permutation_is_a_bijection_equal_to_brute_force(spark, n):
    got = spark.range(n).select("id", permuted(F.col("id"), n, 5).alias("x")).toPandas().set_index("id").x
    assert sorted(got) == list(range(n))
    assert [got[i] for i in range(n)] == [_image(i, n, 5) for i in range(n)]


def test_shuffled_labels_follow_the_permutation_on_any_partitions(spark):
    rows = [(i * 3, i % 4 if i % 9 else None, "x") for i in range(101)]
    df = spark.createDataFrame(rows, "row_id long, label int, _moved string")
    want = {3 * i: rows[_image(i, 101, 42)][1] for i in range(101)}
    for parts in (1, 5):
        out = shuffle_labels(df.repartition(7), "label", num_partitions=parts)
        assert out.columns == df.columns
        assert {r.row_id: r.label for r in out.collect()} == want
    assert shuffle_labels(df.limit(0), "label").count() == 0


def test_sample_and_split_are_repeatable(spark):
    df = spark.range(207).withColumnRenamed("id", "row_id")
    order = sorted(range(207), key=lambda i: (_number(f"42:{i}"), i))
    assert {r[0] for r in sample_exact(df.repartition(5), 0.1).collect()} == set(order[:20])
    assert {r[0] for r in random_split(df).where("split = 'test'").collect()} == {i for i in range(207) if _number(f"42:{i}") % 10 == 0}
    assert sample_exact(df.limit(0), 0.5).count() == 0


SCHEMA = "k long, d double, s string, a array<double>, b boolean, t timestamp_ntz"
T0 = pd.Timestamp("2024-05-01 10:00:00.000001").to_pydatetime()
ROWS = [(1, 0.1, "x", [1.0, None], True, T0), (2, -1e-20, "", [], False, None), (3, float("nan"), None, None, None, T0),
        (4, 1e300, "x", [0.1], True, T0), (5, None, "y", [0.1], True, T0)]


def _changed(i, c, value):
    rows = [list(r) for r in ROWS]
    rows[i][c] = value
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("rows, column", [
    (_changed(0, 1, 0.1 + 2 ** -56), "d"), (_changed(1, 1, 0.0), "d"), (_changed(2, 1, None), "d"), (_changed(3, 2, ""), "s"),
    (_changed(0, 3, [1.0]), "a"), (_changed(1, 4, None), "b"), (_changed(0, 5, T0.replace(microsecond=2)), "t")])
def test_one_changed_value_is_seen(spark, rows, column):
    out = FP.compare(spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(rows, SCHEMA), ["k"])
    assert {r["column"] for r in out.where("not same").collect()} == {column}


def test_fingerprints_ignore_order_and_see_moved_values_and_absent_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert FP.compare(df, df.repartition(3, "s"), ["k"]).where("not same").count() == 0
    swapped = spark.createDataFrame(_changed(4, 2, "x")[:3] + [_changed(3, 2, "y")[3]] + [_changed(4, 2, "x")[4]], SCHEMA)
    assert [r["column"] for r in FP.compare(df, swapped, ["k"]).where("not same").collect()] == ["s"]
    assert FP.compare(df, swapped).where("not same").count() == 0  # without a key only the values count
    assert [r["column"] for r in FP.compare(df.drop("b"), df, ["k"]).where("not same").collect()] == ["b"]
    assert {(r.n_rows, r.n_null, r.digest) for r in FP.fingerprints(df.limit(0)).collect()} == {(0, 0, "0")}


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_tie_ranks_with_a_value_over_many_partitions(spark, parts):
    rng = np.random.default_rng(parts)
    x = np.where(rng.random(3000) < 0.4, 7.0, np.round(rng.normal(7, 3, 3000), 1))
    x[:5], x[5:8] = np.nan, 0.0
    pdf = pd.DataFrame({"row_id": np.arange(3000), "x": x})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("row_id") > 1, F.col("x")))
    ranked, n = tie_ranks(df, "x", "r", parts)
    got = ranked.toPandas().sort_values("row_id")
    assert n == 2995
    np.testing.assert_allclose(got.r.to_numpy(), pdf.x.rank().to_numpy())
    one = spark.createDataFrame([(i, 3) for i in range(50)], "row_id long, x int")
    assert {r.r for r in tie_ranks(one, "x", "r", parts)[0].collect()} == {25.5}


def test_percentile_rank_of_an_empty_table_and_of_strings(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "s string")
    assert percentile_rank(df.limit(0), "s").count() == 0
    assert sorted((r.s or "", r.pct_rank) for r in percentile_rank(df, "s").collect()) == [("", None), ("a", 1 / 3), ("b", 2.5 / 3), ("b", 2.5 / 3)]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_order_violations_across_partition_borders(spark, parts):
    rng = np.random.default_rng(1)
    keys = [int(k) for k in rng.integers(0, 50, 300)]
    df = spark.createDataFrame(list(enumerate(keys)), "t long, k long").repartition(parts)
    want = sum(b < a for a, b in zip(keys, keys[1:]))
    assert tuple(order_violations(df, "k", ["t"]).first()) == (300, want)
    assert tuple(order_violations(df.withColumn("k", F.col("t")), "k", ["t"]).first()) == (300, 0)
    assert tuple(order_violations(df.limit(0), "k", ["t"]).first()) == (0, 0)
