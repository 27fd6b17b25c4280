"""Global-order primitives: equal for 1 and many partitions, equal to single-node results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators import evaluate as E
from vigil.operators import rank as R
from vigil.operators import split as S


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({"row_id": np.arange(n), "x": rng.integers(0, 50, n).astype(float),
                        "y": (rng.random(n) < 0.2).astype(int), "t": rng.integers(0, 400, n)})
    pdf.loc[::97, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_global_rank_matches_sort(data, parts):
    pdf, df = data
    got = R.global_rank(df, ["t", "row_id"], "pos", parts).toPandas().sort_values("pos")
    assert list(got.row_id) == list(pdf.sort_values(["t", "row_id"]).row_id)
    assert list(got.pos) == list(range(len(pdf)))


def _auc_bruteforce(s, y):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_global_rank_and_prefix_sums_keep_null_longs(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(i, None if i % 3 else big + i, float(i)) for i in range(50)], "row_id long, other long, w double")
    for got in (R.global_rank(df, ["row_id"], "pos", 4), R.prefix_sums(df, ["row_id"], {"pos": "w"}, 4)):
        assert got.schema["other"].dataType.simpleString() == "bigint"
        assert {r.row_id: r.other for r in got.collect()} == {i: None if i % 3 else big + i for i in range(50)}
    assert {r.row_id: r.pos for r in got.collect()} == {i: i * (i - 1) / 2 for i in range(50)}


def test_auc_exact_with_ties(data):
    pdf, df = data
    sub = pdf.dropna()
    got = E.roc_auc(df, "x", "y").first()
    assert got["roc_auc"] == pytest.approx(_auc_bruteforce(sub.x.to_numpy(), sub.y.to_numpy()), abs=1e-12)


def test_grouped_auc(data):
    pdf, df = data
    got = {r["g"]: r["roc_auc"] for r in E.roc_auc(df.withColumn("g", F.col("t") % 3), "x", "y", by=["g"]).collect()}
    for g in range(3):
        sub = pdf[(pdf.t % 3 == g)].dropna()
        assert got[g] == pytest.approx(_auc_bruteforce(sub.x.to_numpy(), sub.y.to_numpy()), abs=1e-12)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 0)], "s double, y int")
    assert E.roc_auc(df, "s", "y").first()["roc_auc"] is None


def test_split_sizes_and_order(data, spark):
    pdf, df = data
    out = S.split_3way(df.withColumnRenamed("t", "transaction_date")).toPandas()
    assert (out.split == "train").sum() == int(0.8 * len(pdf))
    assert (out.split == "val").sum() == int(0.1 * len(pdf))
    order = out.sort_values(["transaction_date", "row_id"]).split.tolist()
    assert order == sorted(order, key=["train", "val", "test"].index)


def test_sample_exact_count(data):
    _, df = data
    assert S.sample_exact(df, 0.1, seed=42).count() == int(3000 * 0.1)


def test_shuffle_labels_is_permutation(data):
    pdf, df = data
    out = S.shuffle_labels(df, "y", seed=3).toPandas()
    assert len(out) == len(pdf) and out.y.sum() == pdf.y.sum()
