"""CSV source: declared types, header order, bad records, absent columns; event time and rate checks on edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from vigil.functions.clean import event_time
from vigil.operators.quality import representative_rate, target_absent
from vigil.sources.csv import read_csv


def test_good_and_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("V2,Time,Amount,Class,Extra Note\n0.5,1,2.25,0,x\n,2,,1,\noops,3,1,0,y\n1,2\n")
    t = read_csv(spark, str(tmp_path / "a.csv"))
    assert t.rows.columns == ["v2", "time", "amount", "class", "extra_note"]
    assert sorted(map(tuple, t.rows.collect()), key=str) == sorted([(0.5, 1.0, 2.25, 0, "x"), (None, 2.0, None, 1, None)], key=str)
    assert sorted(r.record for r in t.bad.collect()) == ["1,2", "oops,3,1,0,y"]
    assert t.bad.count() == 2
    assert t.missing == [f"v{i}" for i in range(1, 29) if i != 2]


def test_dates_and_header_alone(spark, tmp_path):
    (tmp_path / "b.csv").write_text("transaction_date,quantity,is_fraudulent\n2023-05-06 07:08:09,1,0\n2023-05-06,2,1\nsoon,3,1\n")
    t = read_csv(spark, str(tmp_path / "b.csv"))
    assert {r.transaction_date for r in t.rows.collect()} == {dt.datetime(2023, 5, 6, 7, 8, 9), dt.datetime(2023, 5, 6)}
    assert t.bad.count() == 1 and t.missing == []
    (tmp_path / "c.csv").write_text("time,amount\n")
    t = read_csv(spark, str(tmp_path / "c.csv"))
    assert t.rows.count() == 0 and t.bad.count() == 0


def test_event_time_and_checks(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None), (3, float("nan"))], "row_id long, time double")
    out = event_time(df)
    assert [r.transaction_date for r in out.orderBy("row_id").collect()] == [dt.datetime(2023, 1, 1, 0, 0, 1, 500000), None, None]
    assert event_time(out) is out
    flags = {r.feature: r.is_target for r in target_absent(df.withColumn("Is_Fraudulent", F.lit(0))).collect()}
    assert flags == {"row_id": False, "time": False, "Is_Fraudulent": True}
    rates = spark.createDataFrame([("a", 1)] + [("a", 0)] * 499 + [("b", 1), ("c", None)], "split string, is_fraudulent int")
    assert {r.split: r.representative for r in representative_rate(rates).collect()} == {"a": True, "b": False, "c": False}
