"""Statistics of many features take one narrow aggregate."""

import numpy as np
from pyspark.sql import functions as F

from vigil.operators.quality import wide_stats
from vigil.operators.scale import fit_scaler


def test_statistics_of_many_features(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(3, 2, (200, 30))
    names = [f"f{i}" for i in range(30)]
    df = spark.createDataFrame([("a" if i % 3 else None, *map(float, r)) for i, r in enumerate(x)], "g string, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    stats = {"mean": F.avg, "largest": F.max, "of_a": lambda v: F.sum(F.when(F.col("g") == "a", v))}
    got = wide_stats(df, names, stats, using=["g"])
    assert len(got._jdf.queryExecution().analyzed().toString()) < 20_000  # no aggregate per feature
    got = {r.feature: r for r in got.collect()}
    mine = np.arange(200) % 3 > 0
    for i, n in enumerate(names):
        np.testing.assert_allclose([got[n]["mean"], got[n].largest, got[n].of_a], [x[:, i].mean(), x[:, i].max(), x[mine, i].sum()], rtol=1e-12)
    by = wide_stats(df, names, {"n": F.count}, by=["g"]).collect()
    assert len(by) == 60 and {(r.g, r.n) for r in by} == {(None, 67), ("a", 133)}
    empty = wide_stats(df.limit(0), names, {"mean": F.avg}).collect()
    assert [r.feature for r in empty] and len(empty) == 30 and {r["mean"] for r in empty} == {None}
    scaler = fit_scaler(df.withColumn("zero", F.lit(0.0)), [*names, "zero"])
    np.testing.assert_allclose([scaler.mean[n] for n in names], x.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose([scaler.std[n] for n in names], x.std(axis=0), rtol=1e-12)
    assert (scaler.mean["zero"], scaler.std["zero"]) == (0.0, 1.0)
