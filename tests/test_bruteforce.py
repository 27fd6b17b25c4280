"""Operators without an SQL oracle, checked against single-node brute force on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.operators import windows as W
from vigil.operators.split import hash_key, sample_exact
from vigil.plans import prepare as P


def _yj_np(x, lam):
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else ((x[pos] + 1) ** lam - 1) / lam
    out[~pos] = -np.log1p(-x[~pos]) if abs(lam - 2) < 1e-12 else -((1 - x[~pos]) ** (2 - lam) - 1) / (2 - lam)
    return out


def _loglik_np(x, lam):
    y = _yj_np(x, lam)
    return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_yeo_johnson_lambda_is_the_likelihood_maximum(spark):
    df = P.clean_card(spark, SF_SMALL).select("row_id", "amount")
    x = np.array([r[0] for r in df.select("amount").collect()])
    lam = W.fit_yeo_johnson(df, "amount")
    grid = np.linspace(-3, 3, 6001)
    best = grid[np.argmax([_loglik_np(x, g) for g in grid])]
    assert abs(lam - best) <= 2e-3
    got = W.yeo_johnson(df, "amount", lam).toPandas().sort_values("row_id")
    want = _yj_np(got.amount.to_numpy(), lam)
    want = (want - want.mean()) / want.std()
    np.testing.assert_allclose(got.amount_power.to_numpy(), want, atol=1e-9)


def test_sample_exact_is_the_hash_order_prefix(spark):
    df = P.clean_card(spark, SF_SMALL).select("row_id")
    pdf = df.withColumn("h", hash_key("row_id", 42)).toPandas().sort_values(["h", "row_id"])
    k = int(len(pdf) * 0.1)
    got = {r[0] for r in sample_exact(df, 0.1, seed=42).collect()}
    assert got == set(pdf.row_id.iloc[:k])


def test_percentile_rank_matches_pandas(spark):
    df = P.clean_card(spark, SF_SMALL).select("row_id", "amount")
    got = W.percentile_rank(df, "amount").toPandas().sort_values("row_id")
    want = got.amount.rank(pct=True)
    np.testing.assert_allclose(got.pct_rank.to_numpy(), want.to_numpy(), atol=1e-12)


def test_rolling_matches_pandas_time_windows(spark):
    from vigil.sources.tables import read_table
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "user_id", "ts", "value")
    got = W.rolling(ev, "user_id", "ts", {"m": (W.US["7D"], "mean", "value"), "c": (W.US["1H"], "count", "value")},
                    split=3).toPandas().set_index("event_id").sort_index()
    pdf = ev.toPandas().sort_values(["user_id", "ts"])
    m, c = {}, {}
    for _, g in pdf.groupby("user_id"):
        s = g.set_index("ts")["value"]
        for eid, a, b in zip(g.event_id, s.rolling("7D").mean(), s.rolling("1h").count()):
            m[eid], c[eid] = a, b
    np.testing.assert_allclose(got.m.to_numpy(), pd.Series(m).sort_index().to_numpy(), rtol=1e-12)
    np.testing.assert_array_equal(got.c.to_numpy(), pd.Series(c).sort_index().to_numpy())


def test_mlp_validation_loss_decreases(spark):
    from vigil.operators.mlp_ae import fit_mlp
    rng = np.random.default_rng(0)
    z = rng.normal(size=(600, 3))
    x = np.hstack([z, z @ rng.normal(size=(3, 5))])
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(8)])
    pdf["is_val"] = (np.arange(600) >= 480).astype(int)
    df = spark.createDataFrame(pdf).repartition(4)
    model = fit_mlp(df, [f"f{i}" for i in range(8)], val_col="is_val", hidden=(16,), latent=3, epochs=6, lr=1e-2)
    losses = [h["val_loss_of_incoming"] for h in model.history]
    assert losses[-1] < losses[0]
    scores = model.score(df.withColumn("row_id", F.monotonically_increasing_id())).toPandas()
    assert (scores.anomaly_score >= 0).all()
