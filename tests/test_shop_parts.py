"""The shop table is joined and sorted in parts whose shuffle files follow each other on the disk."""

import datetime as dt
import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from vigil.operators.rank import global_rank
from vigil.plans import prepare as P
from vigil.session import ensure_checkpoint_dir, stored


def _tables(spark, path: str, orders: int) -> str:
    """Shop tables with null, repeated and dangling keys; rows of one key differ above the cap of the quantity."""
    r = random.Random(3)
    some = lambda v: None if r.random() < 0.02 else v
    day = dt.datetime(2024, 1, 1)
    line = [(some(r.randrange(orders + 20)), some(r.randrange(70)), r.randrange(9), some(r.randrange(1, 4)), some(float(r.randrange(1, 60))),
             some(r.uniform(1, 1e4)), some(r.randrange(11) / 100), some(r.choice("RAN"))) for _ in range(4 * orders)]
    line += line[: orders // 9] + [(7, 3, 1, 1, float(q), 5.0 - q / 100, 0.1, "R") for q in range(50, 90)]
    order = [(some(i), some(r.randrange(40)), some(day + dt.timedelta(days=r.randrange(90))), some(r.choice(["1-URGENT", "5-LOW"]))) for i in range(orders)]
    customer = [(some(i), some(i % 6), some(r.choice(["AUTO", "HOME"]))) for i in range(38)]
    part = [(some(i), some(f"t{i % 7}")) for i in range(65)]
    tables = {
        "lineitem": (line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"),
        "orders": (order + order[:3], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": (customer + customer[5:6], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(i, some(f"n{i}")) for i in range(5)], "n_nationkey int, n_name string"),
        "part": (part + part[9:10], "p_partkey long, p_type string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("parts", [2, 4])
def test_parts_make_the_same_rows(spark, tmp_path, monkeypatch, parts):
    sf = _tables(spark, str(tmp_path), 300)
    whole = P.clean_shop(spark, sf)
    monkeypatch.setattr(P, "PART_BYTES", 1)
    monkeypatch.setattr(P, "SHOP_PARTS", parts)
    got = P.clean_shop(spark, sf)
    assert got.schema == whole.schema
    want = sorted(map(repr, whole.collect()))
    assert len(want) > 600 and sorted(map(repr, got.collect())) == want
    ids = [r.row_id for r in got.select("row_id", "transaction_date").orderBy("row_id").collect()]
    assert ids == list(range(len(want)))


@pytest.mark.parametrize("dates", [[None] * 30, [dt.date(2024, 1, 1)] * 30, [None, dt.date(2024, 1, 2), dt.date(2024, 1, 1)] * 10, []])
def test_rank_in_parts(spark, dates):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "d date, k int")
    want = {r.k: r.rank for r in global_rank(df, ["d", "k"]).collect()}
    assert {r.k: r.rank for r in global_rank(df, ["d", "k"], parts=3).collect()} == want and sorted(want.values()) == list(range(len(dates)))


def _shuffle_bytes(spark) -> int:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = [f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*.data", recursive=True)]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def test_the_joined_table_goes(spark, tmp_path, monkeypatch):
    """a held copy of the joined table stayed beside the shuffle files of all joins and of the sort."""
    sf = _tables(spark, str(tmp_path), 300)
    kept = ensure_checkpoint_dir(spark).removeprefix("file:")
    tables = set(glob.glob(f"{kept}/table-*"))
    monkeypatch.setattr(P, "PART_BYTES", 1)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    got = P.clean_shop(spark, sf)
    new = set(glob.glob(f"{kept}/table-*")) - tables
    assert len(new) == 1 and got.count() == spark.read.parquet(*new).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held


def test_shuffle_files_of_a_part_go_before_the_next(spark):
    """they stayed until the driver collected its garbage."""
    start, left = _shuffle_bytes(spark), []

    def part(i: int):
        for _ in range(100 if i else 0):  # files are removed in the background
            left[i - 1:] = [_shuffle_bytes(spark) - start]
            if left[-1] < 100_000:
                break
            time.sleep(0.1)
        return spark.range(100_000).withColumn("x", F.xxhash64("id")).repartition(8, "x")  # above 1,000,000 bytes

    held, remove = stored([lambda i=i: part(i) for i in range(3)])
    assert held.count() == 300_000 and len(left) == 2 and max(left) < 100_000
    remove()


def test_stored_parts_are_one_table(spark):
    held, remove = stored([lambda i=i: spark.range(5).select((F.col("id") + 5 * i).alias("k"), F.lit("x").alias("s")) for i in range(3)])
    assert sorted(r.k for r in held.collect()) == list(range(15)) and held.columns == ["k", "s"]
    path = held.inputFiles()[0]
    remove()
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(path)
