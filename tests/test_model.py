"""The fitted model: moments and components against numpy, and the same answers in another session."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ROOT, SF_SMALL
from vigil.functions.clean import card_clean_params
from vigil.operators.features import UnfittedError
from vigil.operators.model import AnomalyModel
from vigil.operators.moments import moments
from vigil.plans import prepare as P
from vigil.sources.fixtures import card


@pytest.mark.parametrize("parts", [1, 7])
def test_moments_are_those_of_numpy(spark, parts):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1, (500, 3)) * [1, 1e-3, 5]
    label = rng.integers(0, 2, 500)
    df = spark.createDataFrame([(int(g), *map(float, r)) for g, r in zip(label, x)], "g int, a double, b double, c double").repartition(parts)
    got = moments(df, ["a", "b", "c"], F.col("g"))
    for g in (0, 1):
        part = x[label == g]
        assert got[g].n == len(part)
        np.testing.assert_allclose(got[g].mean, part.mean(axis=0), rtol=1e-12)
        np.testing.assert_allclose(got[g].comoment / got[g].n, np.cov(part.T, bias=True), rtol=1e-6, atol=1e-9)
    assert moments(df.limit(0), ["a"]) == {}


def test_fit_is_that_of_numpy_and_loads_in_another_session(spark, tmp_path):
    split = P.card_split(spark, SF_SMALL)
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    model = AnomalyModel.fit(train, clean_params=card_clean_params(card(spark, SF_SMALL)))
    names = model.scaler.features
    table = model.features.transform(train, keep=("row_id", "is_fraudulent")).toPandas()
    x, normal = table[names].to_numpy(dtype=float), table.is_fraudulent.to_numpy() == 0
    std = x.std(axis=0)
    std[std == 0] = 1
    z = (x - x.mean(axis=0)) / std
    z0 = z[normal] - z[normal].mean(axis=0)
    want = np.linalg.svd(z0, full_matrices=False)[2][:16]
    error = ((z0 - z0 @ want.T @ want) ** 2).mean(axis=1)
    got = model.score(train).toPandas().set_index("row_id").anomaly_score.loc[table.row_id[normal]].to_numpy()
    np.testing.assert_allclose(got, error, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(model.linear.threshold, np.percentile(error, 95), rtol=1e-6)

    model.save(spark, f"{tmp_path}/model")
    model.predict(test).write.parquet(f"{tmp_path}/here")
    code = f"""
from vigil.session import build_session
from vigil.operators.model import AnomalyModel
from vigil.plans import prepare as P
spark = build_session(2, 2)
test = P.card_split(spark, {SF_SMALL!r}).where("split = 'test'").drop("split")
AnomalyModel.load(spark, {str(tmp_path / 'model')!r}).predict(test).write.parquet({str(tmp_path / 'there')!r})
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=300).returncode == 0
    here, there = ({r.row_id: (r.anomaly_score, r.predicted_fraud) for r in spark.read.parquet(f"{tmp_path}/{d}").collect()} for d in ("here", "there"))
    assert here.keys() == there.keys() and all(abs(here[k][0] - there[k][0]) <= 1e-9 * here[k][0] and here[k][1] == there[k][1] for k in here)


def test_unfinished_saves_and_one_class(spark, tmp_path):
    with pytest.raises(UnfittedError):
        AnomalyModel.load(spark, f"{tmp_path}/none")
    split = P.card_split(spark, SF_SMALL)
    with pytest.raises(UnfittedError):
        AnomalyModel.fit(split.where("is_fraudulent = 1").drop("split"))
