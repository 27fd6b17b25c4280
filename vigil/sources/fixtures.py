"""The two table shapes the engine knows, built from the driver tables.

``card``: one row per event; ``time`` is whole seconds since 2024-01-01, the
28 ``v`` components come from the embedding whose id is ``event_id % 500``.
``shop``: one row per line item with customer, account-age and category
columns. Both are plain joins, so Catalyst prunes columns and AQE picks the
join strategy from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources.tables import read_table

N_V = 28
EMBED_KEYS = 500  # fixed value: events map onto the first 500 embeddings
CARD_EPOCH = "2024-01-01 00:00:00"
SHOP_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity", "l_extendedprice"]


def card(spark: SparkSession, sf_dir: str, with_user: bool = False, events: DataFrame | None = None) -> DataFrame:
    """Card table; ``events`` may be a streaming DataFrame (stream-static join)."""
    events = events if events is not None else read_table(spark, sf_dir, "events")
    # At most EMBED_KEYS rows survive this filter, so the join side is bounded.
    emb = read_table(spark, sf_dir, "embeddings").where(F.col("vec_id") < EMBED_KEYS)
    emb = emb.select(
        F.col("vec_id"),
        *[F.col("embedding")[i - 1].cast("double").alias(f"v{i}") for i in range(1, N_V + 1)],
        F.col("label"))
    joined = events.join(F.broadcast(emb), F.col("vec_id") == F.col("event_id") % EMBED_KEYS)
    cols = [F.col("event_id").alias("row_id")]
    if with_user:
        cols.append(F.col("user_id"))
    cols += [
        F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{CARD_EPOCH}', ts)").cast("double").alias("time"),
        *[F.col(f"v{i}") for i in range(1, N_V + 1)],
        F.col("value").alias("amount"),
        ((F.col("event_type") == "error") & (F.col("label") == 0)).cast("int").alias("is_fraudulent"),
    ]
    return joined.select(*cols)


def shop(spark: SparkSession, sf_dir: str, keep_keys: bool = True, with_customer: bool = False, part: tuple[int, int] | None = None) -> DataFrame:
    """Raw shop table; ``keep_keys`` keeps the line-item keys used as tie-break. ``part`` (i, k) is the i-th of k parts by order.

    Columns are derived before the joins, so that few and narrow ones are shuffled: line items by part while they have
    no others, then with the part's type by order; customer-side joins share the o_custkey key."""
    lines, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    if part:
        mine = lambda key: F.pmod(F.xxhash64(key), F.lit(part[1])) == part[0]
        lines, orders = lines.where(mine("l_orderkey")), orders.where(mine("o_orderkey"))
    li = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("transaction_amount"),
        F.col("l_quantity").alias("quantity"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09)).cast("int").alias("is_fraudulent"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    types = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    o = (orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").join(first, "o_custkey")
         .join(cust, F.col("c_custkey") == F.col("o_custkey"))
         .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
         .select("o_orderkey", F.col("o_custkey").alias("customer_id"),
                 F.expr("timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate)").alias("transaction_date"),
                 (F.lit(13) + F.col("c_custkey") % 90).cast("int").alias("customer_age"),
                 F.datediff(F.col("o_orderdate"), F.col("first_date")).alias("account_age_days"),
                 F.col("n_name").alias("customer_location"), F.col("o_orderpriority").alias("payment_method"),
                 F.col("c_mktsegment").alias("device_used")))
    j = li.join(types, F.col("p_partkey") == F.col("l_partkey")).join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"] if keep_keys else []
    if with_customer:
        cols.append("customer_id")
    return j.select(*cols, "transaction_date", "transaction_amount", "quantity", "customer_age", "account_age_days", "customer_location",
                    "payment_method", F.col("p_type").alias("product_category"), "device_used", "is_fraudulent")
