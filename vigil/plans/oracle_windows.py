"""DuckDB oracle SQL for the window queries (2.P)."""

from __future__ import annotations

from vigil.plans import oracle_base as B

US_1H, US_24H, US_7D = 3_600_000_000, 86_400_000_000, 7 * 86_400_000_000


def _frame(us: int) -> str:
    return f"PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {us - 1} PRECEDING AND CURRENT ROW"


_VEL = []
for tag, us in (("1h", US_1H), ("24h", US_24H), ("7d", US_7D)):
    _VEL += [f"count(*) OVER ({_frame(us)}) AS count_{tag}",
             f"round(sum(value) OVER ({_frame(us)}), 6) AS sum_{tag}",
             f"round(avg(value) OVER ({_frame(us)}), 6) AS mean_{tag}"]

PAIRS = ["is_late_night", "amount_above_95", "new_account_30", "is_weekend"]
_PAIR_SQL = ", ".join(f"CAST({a} * {b} AS INTEGER) AS {a}_and_{b}"
                      for i, a in enumerate(PAIRS) for b in PAIRS[i + 1:])

ORACLE = {
    "percentile_rank": B.with_(B.CARD, B.CLEAN_CARD, final="""
, r AS (SELECT row_id, (rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0)
               / count(*) OVER () AS p FROM clean_card)
SELECT row_id, round(p, 6) AS pct_rank, CAST(p > 0.95 AS INTEGER) AS high_value FROM r"""),
    "moving_mean_7d": f"""
SELECT event_id, user_id, round(avg(value) OVER ({_frame(US_7D)}), 6) AS mean_7d FROM events""",
    "tx_count_1h": f"""
SELECT event_id, user_id, count(*) OVER ({_frame(US_1H)}) AS tx_count_1h FROM events""",
    "velocity_windows": f"SELECT event_id, {', '.join(_VEL)} FROM events",
    "suspicious_pattern": f"""
WITH r AS (
  SELECT event_id, CAST(hour(ts) >= 23 OR hour(ts) <= 6 AS INTEGER) AS is_late_night,
         CAST((rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0)
              / count(*) OVER () > 0.95 AS INTEGER) AS high_value,
         count(*) OVER ({_frame(US_1H)}) AS tx_count_1h
  FROM events)
SELECT *, CAST((is_late_night = 1 AND high_value = 1) OR tx_count_1h > 10 AS INTEGER) AS suspicious FROM r""",
    "first_merchant_tx": """
WITH first_order AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey),
s AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity AS quantity, l.l_extendedprice,
         o.o_custkey AS customer_id, o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INT)) AS transaction_date
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN first_order f ON f.o_custkey = o.o_custkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(quantity, 6) AS quantity,
       round(l_extendedprice, 6) AS l_extendedprice, customer_id,
       CAST(row_number() OVER (PARTITION BY customer_id, l_suppkey
            ORDER BY transaction_date, l_orderkey, l_linenumber, l_partkey, quantity, l_extendedprice) = 1
            AS INTEGER) AS is_first
FROM s""",
    "flag_pairs": B.with_(*B.SHOP_FEATURES, final=f"""
, f AS (SELECT row_id, is_late_night, amount_above_95, CAST(account_age_days < 30 AS INTEGER) AS new_account_30,
               is_weekend FROM shop_f)
SELECT row_id, {_PAIR_SQL} FROM f"""),
}
