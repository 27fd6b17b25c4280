"""Inputs whose columns are named like an operator's own, ties between rules, and sources smaller than a block."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vigil.llm import html_text, mixing, quality, url_filter

TEXT = " ".join(f"word{i}" for i in range(80)) + "."
EXTRA = ["d", "s", "p", "_p", "n", "_row", "_words", "kept_id", "m_doc", "m_r", "best", "best_host", "at", "line", "label", "print", "r", "i"]


def documents(spark):
    rows = [(i, f"{TEXT} tail{i} {' '.join(f'x{i}y{k}' for k in range(60))}", "en", "a" if i % 2 else None, 1) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(7) for c in EXTRA})


@pytest.mark.parametrize("operator", [quality.judge, mixing.copies, lambda d: corpus_pipeline.quality_rules(d.sparkSession, d, ""),
                                      lambda d: corpus_pipeline.near_duplicates(d.sparkSession, d, ""), lambda d: corpus_pipeline.mix_sources(d.sparkSession, d, "")])
def test_own_columns_pass_through(spark, operator):
    got = operator(documents(spark)).collect()
    assert got and all(r[c] == 7 for r in got for c in EXTRA)


def test_own_columns_of_pages_and_ties_between_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/x"), (2, None), (3, "no scheme")], "page_id long, url string").withColumns({c: F.lit(7) for c in EXTRA})
    rules = url_filter.rule_table(spark, [("net", "/es/", "allow"), ("NET", "/es/", "block"), ("net", "/", "allow")])
    got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    assert all(r[c] == 7 for r in got.values() for c in EXTRA)
    assert (got[1].rule, got[1].verdict) == ("net/es/", "block")  # of two equal rules, block
    assert (got[2].host, got[2].path, got[2].verdict, got[3].rule) == ("", "", "allow", None)
    assert url_filter.judge(pages.limit(0), rules).collect() == []


def test_small_sources_come_near_their_target(spark):
    sizes = {"a": [20], "b": [70], "c": [15, 15, 1], "d": [64] * 50, "e": [3] * 400, "f": [1000]}
    rows, k = [], 0
    for source, words in sizes.items():
        for n in words:
            rows.append((k, source, " ".join(f"w{k}x{j}" for j in range(n))))
            k += 1
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for source, words in sizes.items():
        mine = [r for r in got if r.source == source]
        taken, target, size = sum(r.taken for r in mine), mine[0].target, sum(words)
        assert all(r.taken <= 2 * r.size for r in mine)
        one = size / -(-size // mixing.BLOCK)  # words of an average block
        assert abs(taken - target) <= one / 2 + (mixing.BLOCK - size % mixing.BLOCK if size % mixing.BLOCK else 0) and taken > 0


def test_pages_empty_long_and_with_columns_of_all_names(spark):
    long = "".join(f"<p>line {k} of the page</p>" for k in range(30000))
    rows = [(1, "http://a/x", f"<article>{long}</article>"), (None, None, None), (None, "http://a/y", "x"), (2, "http://a/x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(7) for c in ["shard", "lines", "border", "place", "own", *EXTRA]})
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    want = "\n".join(f"line {k} of the page" for k in range(30000))
    assert got == {(1, "http://a/x"): (want, len(want)), (None, None): ("", 0), (None, "http://a/y"): ("x", 1), (2, "http://a/x"): ("", 0)}
    assert html_text.extract(pages.limit(0)).collect() == []
