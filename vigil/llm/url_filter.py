"""Allow and block rules over URLs (native).

Each URL is expanded into the host-suffix / path-prefix expressions that the
rules can have (the distinct shapes "labels in the host, characters in the
path"), the expressions are equi-joined with the rules on a short prefix of
their SHA-256 digest, the full digests confirm each meeting, and the longest
rule wins. Expressions are made once per different (host, path), so a URL
that a third of all rows share is one row before the join.

Defined results: a null URL or one without ``://`` has an empty host and an
empty path; such rows and rows that no rule fits get ``default``. Repeated
rows are judged alike and all kept. Rules with a null or empty host, or a
path that neither is empty nor begins with ``/``, fit nothing. Of two rules
equal in host and path ``block`` wins; of two fitting rules of equal length
the one with the longer host. Other columns of ``pages`` pass through;
existing columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT = 8  # hex digits of the digest in the join key
#: fixed rules of the contract: host, path, verdict
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


#: names of columns within the operator, reserved so that an input's own columns pass through
BEST, HOST, PATH = (f"__url_{c}" for c in ("best", "host", "path"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict."""
    rules = (rules.where("host <> '' and (path = '' or path like '/%')")
             .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
             .agg(F.max("verdict").alias("rule_verdict"))  # 'block' > 'allow'
             .select(F.concat("host", "path").alias("rule"), "rule_verdict",
                     _labels(F.col("host")).alias("labels"), F.length("path").alias("chars")))
    # one entry per shape, not per rule: host names have at most 127 labels, rule paths few lengths
    shapes = [tuple(r) for r in rules.select("labels", "chars").distinct().collect()]
    # host and path replace columns of that name; the input's url stays
    rows = pages.drop("rule", "verdict").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    if not shapes:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    full = F.sha2("rule", 256)
    rules = rules.select(full.alias("digest"), F.substring(full, 1, SHORT).alias("short"), "rule", "rule_verdict", "labels")
    host, path = F.col("host"), F.col("path")
    found = [F.when((_labels(host) >= k) & (F.length(path) >= c),
                    F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, c))) for k, c in sorted(shapes)]
    seen = (rows.select("host", "path").distinct()
            .withColumn("expression", F.explode(F.array_compact(F.array(*found))))
            .withColumn("seen_digest", F.sha2("expression", 256))
            .withColumn("seen_short", F.substring("seen_digest", 1, SHORT)))
    best = (seen.join(rules, (F.col("seen_short") == F.col("short")) & (F.col("seen_digest") == F.col("digest")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("length"), "labels", "rule", "rule_verdict")).alias(BEST))
            .select(host.alias(HOST), path.alias(PATH), BEST))
    return (rows.join(best, (F.col("host") == F.col(HOST)) & (F.col("path") == F.col(PATH)), "left")
            .withColumn("rule", F.col(f"{BEST}.rule"))
            .withColumn("verdict", F.coalesce(F.col(f"{BEST}.rule_verdict"), F.lit(default)))
            .drop(BEST, HOST, PATH))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, row_number() OVER () AS rid,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
f AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (rid)
"""
