"""Plans of wide tables run as methods that the JVM compiles, and tables are compared without writing their values as text."""

import __spark_entry__ as entry
from vigil.operators import fingerprint as FP
from vigil.session import apply_wide_plan_conf

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_wide_plans_fall_back_where_a_method_would_not_be_compiled(spark, monkeypatch):
    seen = {}
    read = lambda name: lambda s, sf: seen.setdefault(name, s.conf.get(LIMIT))
    monkeypatch.setattr(entry, "all_queries", lambda: {"wide": read("wide")})
    monkeypatch.setattr(entry, "_text_operators", lambda: ({"text": read("text")}, {}))
    for fn in entry.queries().values():
        fn(spark, "")
    apply_wide_plan_conf(spark)
    assert seen == {"wide": "8000", "text": "65535"}
    assert spark.conf.get(LIMIT) == "8000"


def test_a_difference_below_the_digits_of_the_text_is_seen(spark):
    a, b = (spark.createDataFrame([(1, x), (2, None)], "k int, d double") for x in (1e-40, 2e-40))
    assert [(r["column"], r.n_rows) for r in FP.compare(a, b, ["k"]).where("not same").collect()] == [("d", 2)]


def test_equal_values_of_one_or_two_types_are_the_same(spark):
    rows = [(1, 0.0, float("nan"), [1.0, None], 5), (None, None, -1e300, [None, 1.0], None), (1, 0.0, float("nan"), [1.0, None], 5)]
    a = spark.createDataFrame(rows, "k int, d double, e double, a array<double>, n int")
    b = spark.createDataFrame([(k, None if d is None else -0.0, e, x, n) for k, d, e, x, n in rows[::-1]], "k long, d double, e double, a array<double>, n long")
    assert FP.compare(a, b, ["k"]).where("not same").count() == 0
    assert FP.compare(a.limit(0), b.limit(0), ["k"]).where("not same").count() == 0


def test_nulls_that_changed_places_in_an_array_are_seen(spark):
    a, b = (spark.createDataFrame([(1, x)], "k int, a array<double>") for x in ([1.0, None], [None, 1.0]))
    assert [r["column"] for r in FP.compare(a, b, ["k"]).where("not same").collect()] == ["a"]
