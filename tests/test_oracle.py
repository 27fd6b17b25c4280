"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from vigil.plans.harness import compare, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_with_a_callable():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["hour", "n_rows", "n_flagged", "flagged_amount", "n_caught"]
