"""Quality rules with cross-document line frequency (native).

Base measures of each document come from its own words and lines. The method
counts, per host (``source``), in how many different documents each normalised
line stands, takes lines above the limits out, and rejects documents that are
depleted by it.

A line is above the limit if it stands in more than ``max_docs`` different
documents of its host. Documents are different if their whole texts are (by
MD5): copies of one text count once, however many there are. Without this a
document copied a thousand times would lose all its lines, and with them all its
copies, before deduplication keeps one. Texts that differ anywhere count each,
so the lines of more than ``max_docs`` different near copies are above the limit.

Counting is one partial aggregate per (host, line, text) and one per (host,
line), so a line that half of all documents share is a few rows per task. The
frequent lines are joined back on (host, line); nothing is broadcast by hand.

``ORACLE`` states an older rule (more than 20 documents, and sketches of at least
a quarter of them differ). Both give the same rows on sf0.001, sf0.01 and sf0.1;
on tables with long templates or many copies they do not.

Defined results: null text counts as empty, has no words and fails the base
rule; a null host is a host of its own. Repeated rows each count as a document
and each get a result. Other columns pass through; columns named like a result
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import WS, words_of

MAX_DOCS = 20         # a line may stand in so many different documents of a host
MIN_KEPT_SHARE = 0.3  # share of its words that a document must keep


def _pairs(a: Column, shift: int, f) -> Column:
    """Element-wise ``f(a[i], a[i + shift])`` over the places where both exist."""
    n = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, 1 + shift, n), f)


def _let(value: Column, f) -> Column:
    """``f(value)`` with value made once, however often ``f`` uses it and wherever a filter on the result moves."""
    return F.element_at(F.transform(F.array(value), f), 1)


def repeat_words(words: Column) -> Column:
    """Words in three-word runs found twice or more.

    A key has the run's place in its low bits and the upper bits of the run's hash above: sorted,
    equal runs are neighbours, and the whole hashes at both places confirm it."""
    def of_runs(runs: Column) -> Column:
        full = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(runs) + 1.0))).cast("long") - 1
        return _let(full, lambda mask: _let(
            F.sort_array(F.transform(runs, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))),
            lambda keys: of_keys(runs, mask, keys)))

    def of_keys(runs: Column, mask: Column, keys: Column) -> Column:
        place = lambda k: k.bitwiseAND(mask).cast("int")
        same = lambda a, b: ((a.bitwiseXOR(b) >= 0) & (a.bitwiseXOR(b) <= mask)
                             & (F.element_at(runs, place(a) + 1) == F.element_at(runs, place(b) + 1)))
        twins = F.filter(_pairs(keys, 1, lambda a, b: F.when(same(a, b), F.array(place(a), place(b)))), F.isnotnull)
        return _let(F.sort_array(F.array_distinct(F.flatten(twins))), covered)

    def covered(at: Column) -> Column:
        # each repeated run adds its three words but for those that the next one covers too
        gaps = F.aggregate(_pairs(at, 1, lambda a, b: F.least(b - a, F.lit(3))), F.lit(0), lambda t, x: t + x)
        return F.when(F.size(at) > 0, gaps + 3).otherwise(0)

    pairs = lambda a, b: F.xxhash64(a, b)
    return _let(words, lambda w: _let(_pairs(w, 1, pairs), lambda two: _let(_pairs(two, 1, pairs), of_runs))).cast("long")


def base_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return (docs.withColumn("__quality_words", words_of(F.col("text")))
            .withColumn("n_words", F.size("__quality_words").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("__quality_words", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
            .withColumn("n_dup_lines", _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
            .withColumn("n_repeat_words", repeat_words(F.col("__quality_words")))
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .drop("__quality_words"))


def normal_lines(text: Column) -> Column:
    """Lines with a word: white space runs as one space, trimmed, digit runs as 0."""
    flat = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " "), "[0-9]+", "0")
    return F.filter(F.transform(F.split(flat, "\n"), F.trim), lambda x: x != "")


def frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, n_docs) of the lines above the limit; n_docs counts different texts."""
    # the hash is a column before the lines are exploded, else it is made once per line
    lines = docs.select(F.col("source").alias("host"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("print"), "text")
    lines = lines.select("host", "print",
                        F.explode(F.array_distinct(F.transform(normal_lines(F.col("text")), F.md5))).alias("line"))
    return (lines.groupBy("host", "line", "print").agg(F.lit(1).alias("one"))
            .groupBy("host", "line").agg(F.count("one").alias("n_docs")).where(F.col("n_docs") > max_docs))


#: names of columns within the operator, reserved so that an input's own columns pass through
DOC, SOURCE, PRINT, OWN = (f"__quality_{c}" for c in ("doc", "source", "print", "own"))
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate_words", "base_failed", "kept")


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """``docs`` with the base measures, n_boilerplate_words and kept."""
    docs = docs.drop(*RESULT)
    often = frequent_lines(docs, max_docs).select(F.col("host").alias("often_host"), F.col("line").alias("often_line"))
    print_ = F.md5(F.coalesce(F.col("text"), F.lit("")))
    places = docs.select(F.col("doc_id").alias(DOC), F.col("source").alias(SOURCE), print_.alias(PRINT), "text")
    places = places.select(DOC, SOURCE, PRINT, F.posexplode(normal_lines(F.col("text"))).alias("at", "line"))
    places = places.select(DOC, SOURCE, PRINT, "at", F.md5("line").alias("line"), F.size(F.split("line", " ")).alias("n"))
    removed = (places.join(often, F.col(SOURCE).eqNullSafe(F.col("often_host")) & (F.col("line") == F.col("often_line")))
               .groupBy(DOC, SOURCE, PRINT, "at").agg(F.max("n").alias("n"))  # repeated rows are one here
               .groupBy(DOC, SOURCE, PRINT).agg(F.sum("n").alias("n_boilerplate_words")))
    rows = base_measures(docs).withColumn(OWN, print_)
    rows = rows.join(removed, F.col("doc_id").eqNullSafe(F.col(DOC)) & F.col("source").eqNullSafe(F.col(SOURCE)) & (F.col(OWN) == F.col(PRINT)), "left")
    lost = F.coalesce("n_boilerplate_words", F.lit(0)).cast("long")
    return (rows.withColumn("n_boilerplate_words", lost)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - lost >= min_kept_share * F.col("n_words")))
            .drop(DOC, SOURCE, PRINT, OWN))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", *(c for c in RESULT if c != "n_boilerplate_words"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1) GROUP BY rid),
base AS (SELECT d.rid, doc_id, source, t, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
    - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (rid)),
lines AS (SELECT rid, source, md5(t) AS print, trim(unnest(string_split(regexp_replace(regexp_replace(t, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), chr(10))), ' ') AS line FROM base),
often AS (SELECT coalesce(source, chr(0)) AS s, line FROM lines WHERE line <> ''
  GROUP BY source, line HAVING count(DISTINCT print) > 20),
lost AS (SELECT rid, sum(len(string_split(l.line, ' '))) AS n FROM lines l JOIN often o ON coalesce(l.source, chr(0)) = o.s AND l.line = o.line GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - coalesce(n, 0) >= 0.3 * n_words AS kept
FROM base LEFT JOIN lost USING (rid)
"""
