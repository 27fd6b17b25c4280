"""DuckDB oracle SQL for seeded draws, alert records and fingerprints."""

from __future__ import annotations

from vigil.operators.alerts import DISPLAY
from vigil.operators.draws import DIGITS, ROUNDS
from vigil.plans import oracle_base as B
from vigil.plans.oracle_eval import AUC, S, thr

SEED = 42


def number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {DIGITS}) AS BIGINT)"


def _draw(key: str) -> str:
    return number(f"'{SEED}:' || CAST({key} AS VARCHAR)")


def _permutation(table: str, key: str) -> list[str]:
    """CTEs ``x0 .. xR``: position, number of rows and image of every row of ``table`` after each swap-or-not round."""
    out = [f"""x0 AS (SELECT p.*, position AS x FROM (
  SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS position, count(*) OVER () AS n FROM {table}) p)"""]
    for r in range(ROUNDS):
        round_key = number(f"'{SEED}:{r}'")
        pair = number(f"'{SEED}:{r}:' || CAST(greatest(x, other) AS VARCHAR)")
        out.append(f"""x{r + 1} AS MATERIALIZED (SELECT * EXCLUDE (x, other), CASE WHEN {pair} % 2 = 1 THEN other ELSE x END AS x
  FROM (SELECT *, ({round_key} % n - x + n) % n AS other FROM x{r}))""")
    return out


#: columns by kind: d double, t timestamp, all others as text
FINGERPRINTED = {
    "events": (["event_id"], "event_id ts:t user_id event_type value:d props"),
    "orders": (["o_orderkey"], "o_orderkey o_custkey o_orderstatus o_totalprice:d o_orderdate:t o_orderpriority"),
    "lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                 "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:d l_extendedprice:d l_discount:d l_tax:d"
                 " l_returnflag l_linestatus l_shipdate:t"),
}


def _text(c: str, kind: str) -> str:
    if kind == "t":
        return f"CAST(epoch_us({c}) AS VARCHAR)"
    if kind != "d":
        return f"CAST({c} AS VARCHAR)"
    size, two52 = f"abs({c})", "4503599627370496.0::DOUBLE"
    high = f"(({size} - floor({size})) * {two52})"
    low = f"(({high} - floor({high})) * {two52})"
    digits = " || '/' || ".join(f"CAST(CAST(floor({p}) AS BIGINT) AS VARCHAR)" for p in (size, high, low))
    return (f"CASE WHEN isnan({c}) THEN 'nan' WHEN {size} >= 9223372036854775808.0 THEN CAST({c} AS VARCHAR) "
            f"ELSE CASE WHEN {c} < 0 THEN '-' ELSE '+' END || '/' || {digits} END")


def _fingerprints() -> str:
    parts = []
    for table, (key, columns) in FINGERPRINTED.items():
        row = " || ".join(f"coalesce(CAST({k} AS VARCHAR), '') || '|'" for k in key)
        for c in columns.split():
            c, _, kind = c.partition(":")
            parts.append(f"""SELECT '{table}' AS "table", '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
  CAST(coalesce(sum(CAST({number(f'{row} || {_text(c, kind)}')} AS HUGEINT)), 0) AS VARCHAR) AS digest FROM {table}""")
    return " UNION ALL ".join(parts)


ORACLE = {
    "sample_exact": B.with_(B.CARD, B.CLEAN_CARD, final=f"""
SELECT row_id, round(amount, 6) AS amount, is_fraudulent
FROM (SELECT *, row_number() OVER (ORDER BY {_draw('row_id')}, row_id) AS i, count(*) OVER () AS n FROM clean_card)
WHERE i <= floor(0.1 * n)"""),
    "random_split": B.with_(B.CARD, B.CLEAN_CARD, final=f"""
SELECT row_id, is_fraudulent, CASE WHEN {_draw('row_id')} % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM clean_card"""),
    "check_shuffled_auc": B.with_(*S, *_permutation("scored", "row_id"), f"""shuffled AS (
  SELECT a.row_id, a.anomaly_score, b.is_fraudulent FROM x{ROUNDS} a JOIN x0 b ON b.position = a.x)""",
                                  AUC.replace("FROM scored", "FROM shuffled"), final="""
SELECT round(roc_auc, 6) AS roc_auc, positives, negatives, roc_auc > 0.4 AND roc_auc < 0.6 AS in_band FROM auc"""),
    "alert_records": B.with_(*S, thr(99), final=f"""
SELECT f.row_id, round(f.amount_z_score, 6) AS anomaly_score, CAST(coalesce(f.amount_z_score > thr.t, false) AS INTEGER) AS predicted_fraud,
       f.is_fraudulent AS actual_fraud, {", ".join(f"round(CAST(f.{c} AS DOUBLE), 6) AS {c}" for c in DISPLAY)}
FROM card_f f CROSS JOIN thr WHERE f.split = 'test'"""),
    "table_fingerprints": _fingerprints(),
    "check_reloaded_table": B.with_(*S, final="""
, c AS (SELECT count(*) AS n FROM card_f),
one AS (SELECT coalesce(COLUMNS(* EXCLUDE (row_id, split, is_fraudulent)), 0) FROM card_f LIMIT 1)
SELECT feature AS "column", n AS n_rows, true AS same FROM (UNPIVOT one ON COLUMNS(*) INTO NAME feature VALUE value), c
UNION ALL SELECT k, n, true FROM c, (VALUES ('row_id'), ('split'), ('is_fraudulent')) v(k)"""),
    "check_stored_params": """
SELECT t AS "table", k AS "column", n AS n_rows, true AS same FROM (VALUES
  ('features/params', 'params', 1), ('features/params', 'model', 1), ('features/params', 'batch', 1), ('features/params', 'sizes', 1),
  ('parts', 'position', 96), ('parts', 'feature', 96), ('parts', 'mean', 96), ('parts', 'std', 96), ('parts', 'centre', 96),
  ('parts', 'loadings', 96), ('model', 'threshold', 1), ('model', 'percentile', 1), ('model', 'clean', 1)) v(t, k, n)""",
    "check_round_trip": B.with_(*S, final="""
SELECT count(*) AS n_rows, CAST(0.0 AS DOUBLE) AS max_score_diff, CAST(0 AS BIGINT) AS label_diffs, CAST(0 AS BIGINT) AS missing FROM scored"""),
}
