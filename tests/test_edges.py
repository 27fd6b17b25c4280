"""Hand-made edge rows (FIXTURES.md part 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.functions.clean import clean
from vigil.operators import alerts as A
from vigil.operators import evaluate as E
from vigil.operators.features import FeatureModel


def _card_rows(spark, amounts, times=None):
    times = times or list(range(len(amounts)))
    rows = [(i, float(t), 0.1 * i, -0.2 * i, a, i % 2) for i, (a, t) in enumerate(zip(amounts, times))]
    return spark.createDataFrame(rows, "row_id long, time double, v1 double, v2 double, amount double, class int")


def test_null_and_nan_amount_flags_zero(spark):
    df = clean(_card_rows(spark, [1.0, 2.0, None, float("nan"), 5.0, 6.0]))
    fitted = FeatureModel().fit(df)
    out = {r["row_id"]: r for r in fitted.transform(df).collect()}
    for i in (2, 3):
        assert out[i]["amount_above_50"] == 0 and out[i]["amount_log"] == 0.0


def test_zero_spread_scale_is_one(spark):
    df = clean(_card_rows(spark, [3.0] * 5))
    fitted = FeatureModel().fit(df)
    assert fitted.params["amount_scale"] == 1.0
    assert {r["amount_scaled"] for r in fitted.transform(df).collect()} == {0.0}


def test_strict_threshold(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "row_id long, anomaly_score double")
    assert [r["predicted_fraud"] for r in E.predict(df, "anomaly_score", 2.0).orderBy("row_id").collect()] == [0, 0]


def test_max_time_zero_gives_null_date(spark):
    df = clean(_card_rows(spark, [1.0, 2.0], times=[0, 0]))
    assert all(r["transaction_date"] is None for r in df.collect())


def test_age_bins_and_weekday(spark):
    from vigil.functions.customer import age_group
    ages = spark.createDataFrame([(a,) for a in (18, 25, 65, 100, 0, 101)], "a int")
    got = [r[0] for r in ages.select(age_group(F.col("a"))).collect()]
    assert got == ["teen", "young", "senior", "elderly", None, None]
    days = spark.createDataFrame([(dt.datetime(2023, 1, 1),), (dt.datetime(2023, 1, 2),)], "d timestamp_ntz")
    assert [r[0] for r in days.select(F.weekday("d")).collect()] == [6, 0]


@pytest.mark.parametrize("hour,late,business,rush,risk", [
    (0, 1, 0, 0, 1), (4, 1, 0, 0, 1), (6, 1, 0, 0, 0), (7, 0, 0, 1, 0), (9, 0, 1, 1, 0),
    (17, 0, 1, 1, 0), (19, 0, 0, 1, 0), (23, 1, 0, 0, 0)])
def test_hour_flag_bounds(spark, hour, late, business, rush, risk):
    from vigil.functions.temporal import temporal_columns
    df = spark.createDataFrame([(dt.datetime(2023, 3, 1, hour),)], "ts timestamp_ntz")
    r = df.select(*[c.alias(n) for n, c in temporal_columns("ts", {"hour_mean": 12, "hour_std": 1}).items()]).first()
    assert (r["is_late_night"], r["is_business_hours"], r["is_rush_hour"], r["is_high_risk_hour"]) == \
        (late, business, rush, risk)


def test_empty_flag_set_summary_counts(spark):
    df = spark.createDataFrame([(1, 0.1, 1), (2, 0.2, 0), (3, 0.3, 0)], "row_id long, anomaly_score double, is_fraudulent int")
    r = A.alert_summary(df, 10.0).first()
    assert (r["total"], r["flagged"], r["actual_fraud"], r["tn"], r["fn"]) == (3, 0, 1, 2, 1)


def _shop_rows(spark, cats):
    rows = [(dt.datetime(2023, 1, 1 + i), 10.0 * (i + 1), 1.0 + i, 30 + i, 100 + i, "X", c, "p", "d", i % 2)
            for i, c in enumerate(cats)]
    return spark.createDataFrame(rows, "transaction_date timestamp_ntz, transaction_amount double, quantity double, "
                                       "customer_age int, account_age_days int, customer_location string, "
                                       "payment_method string, product_category string, device_used string, "
                                       "is_fraudulent int").withColumn("row_id", F.monotonically_increasing_id())


def test_unseen_category_error_or_keep(spark):
    train = clean(_shop_rows(spark, ["a", "b", "a", "b"]))
    test = clean(_shop_rows(spark, ["c"]))
    with pytest.raises(Exception):
        FeatureModel().fit(train).transform(test).collect()
    r = FeatureModel(handle_invalid="keep").fit(train).transform(test).first()
    assert r["payment_method_encoded"] == 0 and r["payment_method_fraud_rate"] == 0.0


def test_label_codes_alphabetical(spark):
    train = clean(_shop_rows(spark, ["b", "a", "c", "a"]))
    fitted = FeatureModel().fit(train)
    codes = {r[1]: r[2] for r in fitted.encodings.collect() if r[0] == "payment_method"}
    assert codes == {"a": 0, "b": 1, "c": 2}


def test_feature_state_round_trip(spark, tmp_path):
    from vigil.operators.features import FittedFeatures
    df = clean(_card_rows(spark, [1.0, 2.0, 3.0, 4.0, 9.0]))
    fitted = FeatureModel(batch_stats="fitted").fit(df)
    fitted.save(spark, str(tmp_path / "state"))
    back = FittedFeatures.load(spark, str(tmp_path / "state"))
    a = fitted.transform(df).orderBy("row_id").collect()
    b = back.transform(df).orderBy("row_id").collect()
    assert a == b
