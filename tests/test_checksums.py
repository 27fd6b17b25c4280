"""Checksums of many features: exact totals by blocks, the same as sums of decimals."""

import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vigil.operators import checksums, quality
from vigil.operators.checksums import CHECKSUMS, checksum_states
from vigil.operators.quality import wide_stats
from vigil.plans import queries_features as Q

#: the same by one decimal a value
DECIMALS = {"total": lambda x: F.sum(F.round(x, 6).cast("decimal(38,6)")).cast("double"), "n_nonzero": lambda x: F.sum((x != 0).cast("long")),
            "min_value": lambda x: F.round(F.min(x), 6), "max_value": lambda x: F.round(F.max(x), 6)}


def _doubles() -> list[float]:
    rng = np.random.default_rng(4)
    ties = (2 * rng.integers(0, 10**9, 1500) + 1) / 2e6
    near = np.concatenate([np.nextafter(ties, 0), np.nextafter(ties, 1e9)])
    parts = rng.integers(1, 50, 3000) / rng.integers(1, 4000, 3000)  # halves of a millionth among them
    spread = rng.uniform(-1, 1, 3000) * 10.0 ** rng.integers(-9, 9, 3000)
    whole = rng.integers(-2**53, 2**53, 500).astype(float)
    edges = [0.0, -0.0, 5e-7, -5e-7, 0.0078125, 1e8, 99999999.9999995, 9007199254740991.0, 4.9e-324]
    x = np.concatenate([ties, near, parts, spread, whole, edges])
    return [float(v) for v in np.where(np.arange(len(x)) % 3, x, -x)]


def test_totals_are_those_of_decimals(spark):
    x = _doubles()
    rows = [("a" if i % 3 else None, dt.date(2024, 1, 1 + i % 2), v, None if i % 5 == 0 else -v, None, i - 4000, (1 << 31) - 1 - i % 2, i * 10**12, v / 7) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, day date, d double, e double, no double, i int, j int, l long, s double").repartition(5)
    names = ["d", "e", "no", "i", "j", "l", "s"]
    for by in (["g", "day"], []):
        got = {(r.feature, *[r[b] for b in by]): r for r in wide_stats(df, names, CHECKSUMS, by=by, states=checksum_states).collect()}
        want = wide_stats(df, names, DECIMALS, by=by)
        assert len(got) == len(names) * (4 if by else 1)
        for r in want.collect():
            assert got[r.feature, *[r[b] for b in by]] == r
        again = wide_stats(df.repartition(2), names, CHECKSUMS, by=by, states=checksum_states)
        assert again.schema == want.schema and {(r.feature, *[r[b] for b in by]): r for r in again.collect()} == got


def test_totals_of_large_values(spark):
    """Above 10**8 a double's digits are not the same in all engines; the totals differ below its last digit."""
    rng = np.random.default_rng(5)
    x = [123456789.1234565, 1e15 + 0.5, 1e22, -1e25, *map(float, rng.normal(0, 1, 2000) * 10.0 ** rng.integers(8, 25, 2000)), *map(float, rng.integers(2**53, 2**62, 50))]
    rows = [(f"{int(np.log10(abs(v)))}", v) for v in x]
    df = spark.createDataFrame(rows, "g string, d double").repartition(3)
    got, want = ({r.g: r for r in wide_stats(df, ["d"], stats, by=["g"], **more).collect()} for stats, more in ((CHECKSUMS, {"states": checksum_states}), (DECIMALS, {})))
    assert len(got) == len(want) > 15
    for g, r in want.items():
        size = sum(abs(v) for k, v in rows if k == g)
        assert abs(got[g].total - r.total) <= 1e-15 * size and tuple(got[g])[3:] == tuple(r)[3:]


def test_no_rows_and_no_numbers(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, d double")
    assert wide_stats(df.limit(0), ["d"], CHECKSUMS, by=["g"], states=checksum_states).collect() == []
    assert [tuple(r) for r in wide_stats(df.limit(0), ["d"], CHECKSUMS, states=checksum_states).collect()] == [("d", None, None, None, None)]
    with pytest.raises(Exception, match="NaN or infinite"):
        wide_stats(df.withColumn("d", F.lit(float("inf"))), ["d"], CHECKSUMS, states=checksum_states).collect()


def test_nan_is_no_number(spark):
    """totals leave NaN out, as decimals do, instead of failing; it is the greatest value and not zero."""
    n = float("nan")
    rows = [("a", 1.25), ("a", n), ("a", -3.0), ("b", n), ("b", n), ("c", None), ("c", n), ("c", 0.0), ("d", None), ("e", 2.0)]
    df = spark.createDataFrame(rows, "g string, d double")
    for parts in (1, 4):
        got, want = (sorted(map(repr, wide_stats(df.repartition(parts), ["d"], stats, by=["g"], **more).collect()))
                     for stats, more in ((CHECKSUMS, {"states": checksum_states}), (DECIMALS, {})))
        assert got == want and len(got) == 5


def test_workers_need_no_copy_of_the_code(tmp_path):
    """the feature tables' checksums failed where only the driver can import the library."""
    (tmp_path / "sent").write_bytes(cloudpickle.dumps((checksums.Checksum, checksums._parts)))
    code = "import pickle; c = pickle.load(open('sent', 'rb'))[0](); import numpy as np; c.add(np.array([0.5, 1.0])); print(c.state()['total'])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert got.stdout.strip() == "1.500000", got.stderr


def test_feature_tables_make_no_decimal_a_value(spark, monkeypatch):
    """a decimal and a hashed row for each of a row's 100 features took nearly all of the time."""
    seen = []
    monkeypatch.setattr(quality.F, "posexplode", lambda *a: seen.append(a))
    ft = spark.createDataFrame([(1, "train", 0, 0.25, 3), (2, "test", 1, 0.5, 0)], "row_id long, split string, is_fraudulent int, x double, n int")
    got = {(r.feature, r.split): (r.total, r.n_nonzero, r.min_value, r.max_value) for r in Q._checksums(ft).collect()}
    assert got == {("x", "train"): (0.25, 1, 0.25, 0.25), ("x", "test"): (0.5, 1, 0.5, 0.5), ("n", "train"): (3.0, 1, 3.0, 3.0), ("n", "test"): (0.0, 0, 0.0, 0.0)}
    assert not seen
