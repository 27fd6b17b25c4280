"""Plan checks: no single-partition exchange on data-sized input, pushdown reaches the scan."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.operators import rank as R
from vigil.plans import prepare as P


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_has_no_single_partition(spark):
    df = R.global_rank(P.clean_card(spark, SF_SMALL).select("row_id", "transaction_date"),
                       ["transaction_date", "row_id"], "pos")
    assert "SinglePartition" not in _plan(df)


def test_split_filter_pushes_to_parquet(spark):
    from vigil.sources.tables import read_table
    ev = read_table(spark, SF_SMALL, "events").where(F.col("value") > 10).select("event_id")
    plan = _plan(ev)
    assert "GreaterThan(value,10.0)]" in plan.split("PushedFilters: ")[1]
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_feature_plan_is_codegen(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, ft = P.card_features(spark, SF_SMALL)
        plan = _plan(ft)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    top = plan.splitlines()[0]
    assert top.startswith("*(") and "Project" in top  # the 96-column projection runs in whole-stage codegen
    assert "SortMergeJoin" not in plan
