"""Mixing sources to target weights (native).

The words of each source form one stream of fixed-length blocks. A source's
target says how many block slots it gets; a pseudorandom permutation deals all
slots over the output shards, which draws each shard's source counts from the
multinomial distribution conditioned on the sources' totals (so the totals
meet the targets, which free draws would miss by their noise). The j-th slot of
a source takes the block that a second permutation, of the source's own block
indexes, gives for j; a second round over the source uses another permutation.
Documents meet the drawn blocks by index, an equi-join of evenly dealt keys.

Both permutations are swap-or-not shuffles: arithmetic on one index and its
partner, exact on any domain size, needing no sort and no table.

A document's place in its source's stream is a prefix sum in two levels: over
about sqrt(rows) hash buckets per source, then within the bucket, so a source
that holds a third of all rows is as many tasks as any other.

Defined results: null text has size 0, takes nothing and gets its source's
target. Null source is a source of its own, last in the weight order. Repeated
rows are documents of their own. An empty table gives an empty mix. Only the
per-source table (one row a source) is ever ordered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.text import words_of, written

WEIGHTS = (3, 1, 2)  # by source in code-point order, repeating
SHARE = 1.5          # words of the mix for each word of the input
MOST = 2.0           # a source's target stops at so many times its size
BLOCK = 64           # words a block
SHARD = 4096         # slots an output shard
ROUNDS = 24          # of the swap-or-not shuffle
CHUNK = 8192         # slots made from one row at a time
SEED = 20


def swap_or_not(x: Column, n: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """The image of ``x`` in a pseudorandom permutation of [0, n) chosen by ``key``."""
    def step(v: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - v, n)
        return F.when(F.xxhash64(*key, r, F.greatest(v, partner)).bitwiseAND(1) == 1, partner).otherwise(v)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target, the excess over the caps reshared by weight.

    The final state has one level L with target = min(cap, L * weight); in the order of
    cap / weight the capped sources come first, so L follows from running sums."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int"))
    rows = (sizes.withColumn("i", F.row_number().over(order) - 1).withColumn("weight", pick.cast("double"))
            .withColumn("cap", most * F.col("source_size")))
    whole = Window.orderBy(F.col("cap") / F.col("weight"), "i")
    total = share * F.sum("source_size").over(Window.partitionBy())
    left = total - (F.sum("cap").over(whole) - F.col("cap"))
    weigh = F.sum("weight").over(Window.partitionBy()) - (F.sum("weight").over(whole) - F.col("weight"))
    rows = rows.withColumn("level", left / weigh)
    # the first source whose cap is not below the level that is left for it and the rest sets the level
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "i", "level"))).over(Window.partitionBy())["level"]
    return (rows.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))))
            .select("source", "i", "weight", "source_size", "target"))


def _numbers(df: DataFrame, count: str, out: str, tasks: int) -> DataFrame:
    """A row per number in [0, count), made in chunks that are dealt over the tasks first."""
    chunks = (df.where(F.col(count) > 0)
              .withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(CHUNK).cast("long"))))
              .repartition(tasks, "i", "_first"))
    last = F.least(F.col("_first") + CHUNK, F.col(count)) - 1
    return chunks.withColumn(out, F.explode(F.sequence(F.col("_first"), last))).drop("_first")


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK,
         seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their place, sources with their targets, and slots.

    documents: the input without its text, plus size, i (the source), start (words of the
    source before it), source_size and target; sources: source, i, source_size, target,
    blocks, slots; slots: shard, slot, i and block, the content of the mix."""
    sized = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"),
                        F.xxhash64(F.lit(seed), "doc_id", "text").alias("r"))
    sized = written(sized, "mix-sizes")
    buckets = max(1, math.isqrt(sized.count()))
    sized = sized.withColumn("bucket", F.pmod("r", F.lit(buckets)))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most)
    # a source's blocks hold source_size / blocks words on average, less than a full block where the source is small
    wanted = F.coalesce(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))), F.lit(0)).cast("long")
    sources = (targets.withColumn("blocks", F.ceil(F.col("source_size") / block))
               .withColumn("slots", F.least(F.greatest(wanted, (F.col("target") > 0).cast("long")), (most * F.col("blocks")).cast("long"))))
    sources = written(sources.withColumn("first_slot", F.sum("slots").over(Window.orderBy("i")) - F.col("slots")), "mix-sources")
    before = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")
    sums = sums.withColumn("before", before)
    src = sources.select(F.col("source").alias("src"), "i", "source_size", "target")
    sums = sums.join(src, F.col("source").eqNullSafe(F.col("src"))).select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "before", "i", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("r", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (sized.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
              .join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
              .withColumn("start", F.col("before") + F.col("inside"))
              .select("doc_id", "source", "size", "r", "i", "start", "source_size", "target"))
    total = sources.agg(F.sum("slots")).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // 1_000_000)
    turn = F.floor(F.col("j") / F.col("blocks"))
    slots = (_numbers(sources.select("i", "slots", "blocks", "first_slot"), "slots", "j", tasks)
             .withColumn("place", swap_or_not(F.col("first_slot") + F.col("j"), F.lit(max(total, 1)).cast("long"), [F.lit(seed)]))
             .withColumn("block", swap_or_not(F.pmod("j", "blocks"), F.col("blocks"), [F.lit(seed + 1), F.col("i"), turn]))
             .select(F.floor(F.col("place") / SHARD).alias("shard"), F.pmod("place", F.lit(SHARD)).alias("slot"), "i", "block"))
    return placed, sources, slots


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK,
        seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, r (a hash of the row) for every document."""
    placed, _, slots = plan(docs, weights, share, most, block, seed)
    placed = written(placed, "mix-places")  # used twice; holds no text
    drawn = (slots.groupBy(F.col("i").alias("d_i"), F.col("block").alias("d_block")).agg(F.count(F.lit(1)).alias("times")))
    key = ["doc_id", "source", "size", "r", "i", "start", "source_size", "target"]
    pieces = (placed.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
              .withColumn("words", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)))
    # the drawn blocks grow with the corpus, which the planner can't tell from the few rows they are made of
    taken = (pieces.join(drawn.hint("merge"), (F.col("i") == F.col("d_i")) & (F.col("block") == F.col("d_block")))
             .groupBy("i", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
             .select(F.col("i").alias("t_i"), F.col("start").alias("t_start"), "taken"))
    # only documents with words own a start; the others take nothing
    return (placed.select(*key)
            .join(taken, (F.col("i") == F.col("t_i")) & (F.col("start") == F.col("t_start")) & (F.col("size") > 0), "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "r"))


#: names of columns within the operator, reserved so that an input's own columns pass through
DOC, ROW, TIMES = (f"__mix_{c}" for c in ("doc", "row", "times"))


def copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it: the whole part of taken / size, and one
    more with the chance of the rest (decided by the row's hash), so that sums keep their expectation."""
    seed = options.get("seed", SEED)
    ratio = F.col("taken") / F.greatest(F.col("size"), F.lit(1))
    chance = F.pmod(F.xxhash64(F.lit(seed + 2), "r"), F.lit(1 << 30)) / (1 << 30)
    wanted = (mix(docs, **options).groupBy(F.col("doc_id").alias(DOC), F.col("r").alias(ROW))
              .agg(F.max(F.floor(ratio + chance)).cast("int").alias(TIMES)).where(f"{TIMES} > 0"))
    # a row per document: it grows with the corpus, so the join has one plan at every size
    return (docs.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col(DOC)) & (F.xxhash64(F.lit(seed), "doc_id", "text") == F.col(ROW)))
            .withColumn(TIMES, F.explode(F.sequence(F.lit(1), F.col(TIMES)))).drop(DOC, ROW, TIMES))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
