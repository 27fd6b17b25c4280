"""Categorical dictionaries as distributed tables: any size, hot and missing categories, save and load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.operators import features as X


def _shop(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, payment_method string, is_fraudulent int")
    return df.withColumns({"transaction_amount": F.lit(10.0) + F.col("row_id") % 7, "quantity": F.lit(1.0) + F.col("row_id") % 3,
                           "transaction_date": F.lit(dt.datetime(2023, 1, 2)).cast("timestamp_ntz")})


ROWS = ([(i, "cash", i % 2) for i in range(300)] + [(1000 + i, None, 1) for i in range(300)]
        + [(2000 + i, f"card-{i % 150:03d}", int(i % 150 == 3)) for i in range(300)] + [(3000, "\u00e9", 0), (3001, "Z", 1), (3002, "", 0)])
GROUPS = ("amount", "temporal", "customer")


def _expected():
    names = sorted({r[1] for r in ROWS if r[1] is not None})
    rate = {n: [r[2] for r in ROWS if r[1] == n] for n in names}
    return {r[0]: (names.index(r[1]), sum(rate[r[1]]) / len(rate[r[1]])) if r[1] is not None else (0, 0.0) for r in ROWS}


@pytest.mark.parametrize("limit", [X.BROADCAST_BYTES, 0])
def test_codes_and_rates_by_broadcast_and_by_shuffle(spark, monkeypatch, tmp_path, limit):
    monkeypatch.setattr(X, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(X, "HOT_SHARE", 0.2)
    df = _shop(spark, ROWS)
    fitted = X.FeatureModel(groups=GROUPS).fit(df)
    fitted.save(spark, str(tmp_path))
    loaded = X.FittedFeatures.load(spark, str(tmp_path))
    loaded.save(spark, str(tmp_path))  # over the folder that it reads
    for f in (fitted, X.FittedFeatures.load(spark, str(tmp_path))):
        got = {r.row_id: (r.payment_method_encoded, r.payment_method_fraud_rate) for r in f.transform(df).collect()}
        assert len(got) == len(ROWS)
        assert {k: (c, round(v, 9)) for k, (c, v) in got.items()} == {k: (c, round(v, 9)) for k, (c, v) in _expected().items()}


def test_unseen_category(spark, monkeypatch):
    for limit in (X.BROADCAST_BYTES, 0):
        monkeypatch.setattr(X, "BROADCAST_BYTES", limit)
        fitted = X.FeatureModel(groups=GROUPS, handle_invalid="keep").fit(_shop(spark, ROWS))
        out = fitted.transform(_shop(spark, [(1, "never", 0)])).collect()
        assert [(r.payment_method_encoded, r.payment_method_fraud_rate) for r in out] == [(0, 0.0)]
        fitted.model.handle_invalid = "error"
        with pytest.raises(Exception, match="unseen label"):
            fitted.transform(_shop(spark, [(1, "never", 0)])).collect()


def test_two_million_categories(spark):
    n = 2_000_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.format_string("c%07d", F.col("id")).alias("payment_method"),
                               (F.col("id") % 10 == 0).cast("int").alias("is_fraudulent"))
    table, sizes = X._fit_encodings(df, False, ("customer",))
    assert sizes["payment_method"] > X.BROADCAST_BYTES
    bad = table.where((F.col("code") != F.substring("category", 2, 7).cast("int")) | (F.col("freq") != 1)
                      | (F.col("fraud_rate") != (F.col("code") % 10 == 0).cast("double")))
    assert table.count() == n and bad.count() == 0
