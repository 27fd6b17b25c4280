"""Global order without a single partition.

``prefix_sums`` is the primitive behind ranks and exact ROC AUC:

1. ``repartitionByRange`` on the order columns (a unique tie-break is the
   caller's job), ``sortWithinPartitions``;
2. local running sums: positions come from the JVM's own row counter, weighted
   sums from an Arrow pass that reads the weights only and hands all other columns
   on as they are (no second shuffle);
3. the result is checkpointed to the reliable checkpoint folder, so the
   per-partition totals and the rows they describe can never disagree after
   an executor is lost and a partition is recomputed;
4. per-partition totals (one row per partition, bounded by the partition
   count, not by the data) become offsets that are broadcast back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint, stored

PID = "_pid"
#: helper columns of tie ranks: rows before the first and after the last row of the same value within a partition
BEFORE, AFTER = "__before", "__after"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60     # Catalyst's size of a leaf that it knows nothing about
ROW_BITS = 33               # of monotonically_increasing_id: the row in its partition


def leaf_bytes(df: DataFrame) -> int | None:
    """Bytes of the scanned inputs (file sizes of the plan's leaves), None if unknown. Catalyst's
    own estimate for a join is the product of its sides, useless for sizing."""
    it = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while it.hasNext():
        total += int(str(it.next().stats().sizeInBytes()))
    return total if total < UNKNOWN_BYTES else None


def _num_partitions(df: DataFrame, n: int | None) -> int:
    """Range partitions: about 128 MB of input each and at least the default parallelism; where
    the size is unknown, the session's ``spark.sql.shuffle.partitions``."""
    if n:
        return int(n)
    spark = df.sparkSession
    low = spark.sparkContext.defaultParallelism
    size = leaf_bytes(df)
    if size is None:
        return max(low, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(low, math.ceil(size / TARGET_PARTITION_BYTES))


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def prefix_sums(df: DataFrame, order: Sequence[str | Column], weights: dict[str, str | Column],
                num_partitions: int | None = None) -> DataFrame:
    return prefix_sums_with_totals(df, order, weights, num_partitions)[0]


def prefix_sums_with_totals(df: DataFrame, order: Sequence[str | Column], weights: dict[str, str | Column],
                            num_partitions: int | None = None) -> tuple[DataFrame, list[float]]:
    """Add ``<name>`` = exclusive prefix sum of each weight in the global order.

    ``weights`` maps output column name -> weight expression (numeric).
    Rows with equal order keys get an arbitrary but fixed relative order; pass a
    unique tie-break in ``order`` when that matters.
    """
    names = list(weights)
    tmp, local = [f"_w_{i}" for i in range(len(names))], [f"_l_{i}" for i in range(len(names))]
    base = df.withColumns({t: F.coalesce((F.col(w) if isinstance(w, str) else w).cast("double"), F.lit(0.0)) for t, w in zip(tmp, weights.values())})
    ranged = _ranged(base, order, num_partitions).withColumn(PID, F.spark_partition_id())
    schema = T.StructType(ranged.schema.fields + [T.StructField(c, T.DoubleType(), False) for c in local])

    def running(batches):
        carry = np.zeros(len(names))
        for batch in batches:
            if batch.num_rows:
                values = np.column_stack([batch.column(t).to_numpy() for t in tmp])
                sums = np.cumsum(values, axis=0) + carry
                carry = sums[-1]
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (sums - values).T)], [*batch.schema.names, *local])

    done = checkpoint(ranged.mapInArrow(running, schema))
    totals = done.groupBy(PID).agg(*[F.sum(t).alias(t) for t in tmp])
    placed, run = _with_offsets(done, totals, tmp)
    res = placed.withColumns({n: F.col(f"_o_{t}") + F.col(c) for n, t, c in zip(names, tmp, local)})
    return res.drop(PID, *tmp, *local, *(f"_o_{t}" for t in tmp)), run


def _ranged(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None) -> DataFrame:
    cols = _as_cols(order)
    return df.repartitionByRange(_num_partitions(df, num_partitions), *cols).sortWithinPartitions(*cols)


def _with_offsets(rows: DataFrame, totals: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list]:
    """``rows`` with ``_o_<name>``: the totals of all partitions before; and the grand totals."""
    by_pid = {r[PID]: [r[n] or 0 for n in names] for r in totals.collect()}  # one row per range partition
    run: list = [0.0 if isinstance(totals.schema[n].dataType, T.DoubleType) else 0 for n in names]
    offsets = []
    for pid in sorted(by_pid):
        offsets.append((pid, *run))
        run = [a + b for a, b in zip(run, by_pid[pid])]
    schema = T.StructType([T.StructField(PID, T.IntegerType(), False)] + [T.StructField(f"_o_{n}", totals.schema[n].dataType) for n in names])
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(offsets, schema)), PID, "left"), run


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank",
                num_partitions: int | None = None, drop: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """0-based position of each row in the global order (``order`` must be unique). All in the JVM, so
    columns keep their types and nulls. Columns ``drop`` are only needed for the order and not written.

    With ``parts`` the rows of ``df``, which is read for each, are sorted in so many parts by ranges of the first order
    column: a shuffle holds one part at a time, and the result is a compressed table instead of a checkpoint."""
    at = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))

    def ranked(rows: DataFrame, n: int | None, start: int) -> DataFrame:
        ranged = _ranged(rows, order, n).drop(*drop).withColumn("_id", F.monotonically_increasing_id())
        return ranged.withColumns({PID: F.shiftright("_id", ROW_BITS).cast("int") + start, "_at": at}).drop("_id")

    if parts is None:
        done = checkpoint(ranked(df, num_partitions, 0))
    else:
        first = _as_cols(order)[0]
        n = math.ceil(_num_partitions(df, num_partitions) / parts)
        done, _ = stored([lambda i=i, rows=rows: ranked(rows, n, i * n) for i, rows in enumerate(_ranges(df, first, parts))])
    placed, _ = _with_offsets(done, done.groupBy(PID).agg(F.count(F.lit(1)).alias("_n")), ["_n"])
    return placed.withColumn(name, F.col("_o__n") + F.col("_at")).drop(PID, "_at", "_o__n")


def _ranges(df: DataFrame, x: Column, parts: int) -> list[DataFrame]:
    """The rows of ``df`` in ``parts`` ranges of ``x`` of about one size, null first (fewer where few values are frequent)."""
    cuts = df.agg(F.percentile_approx(x, [i / parts for i in range(1, parts)], 1000)).first()[0] if parts > 1 else None
    cuts = [key_literal(v) for v in dict.fromkeys(cuts or [])]
    if not cuts:
        return [df]
    return [df.where(x.isNull() | (x < cuts[0])), *[df.where((x >= lo) & (x < hi)) for lo, hi in zip(cuts, cuts[1:])], df.where(x >= cuts[-1])]


def key_literal(v) -> Column:
    """Literal for a collected key value; timestamps stay zone-free (TIMESTAMP_NTZ)."""
    import datetime as _dt
    if isinstance(v, _dt.datetime):
        return F.expr(f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'")
    return F.lit(v)


def before_key(cols: Sequence[str], key: tuple | None) -> Column:
    """Lexicographic ``(cols) < key``; ``None`` key means +infinity."""
    if key is None:
        return F.lit(True)
    cond = None
    for i in range(len(cols) - 1, -1, -1):
        c, v = F.col(cols[i]), key_literal(key[i])
        term = c < v if cond is None else (c < v) | ((c == v) & cond)
        cond = term
    return cond


def _run_starts(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add the position, in its sorted partition, of the first row of each row's value. Holds one batch."""
    at = df.columns.index(col)

    def run(batches):
        seen, last, first = 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(at).to_numpy(zero_copy_only=False)
            new = np.append(seen == 0 or x[0] != last, x[1:] != x[:-1])
            starts = np.maximum.accumulate(np.where(new, np.arange(seen, seen + len(x)), first))
            seen, last, first = seen + len(x), x[-1], int(starts[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts)], [*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.LongType(), False)]))


def tie_ranks(df: DataFrame, col: str, name: str = "avg_rank", num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with the average 1-based rank of ``col`` among equal values (null and NaN: null), and how many rows have one.

    One range exchange, by the value and a hash of the row, so rows of a frequent value lie in many partitions (equal whole rows
    in one). Ranks inside a partition follow from two local sorts; a value that may go on in another partition is the first or
    last of its own, and those, two for each partition, are added up on the driver."""
    x = F.col(col)
    kind = df.schema[col].dataType
    ranked = x.isNotNull() & ~F.isnan(x) if isinstance(kind, (T.DoubleType, T.FloatType)) else x.isNotNull()
    parts = _num_partitions(df, num_partitions)
    rows = checkpoint(df.where(ranked).repartitionByRange(parts, x, F.xxhash64(*[F.col(c) for c in df.columns]))
                      .withColumn(PID, F.spark_partition_id()))
    ends = rows.groupBy(PID).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    held = rows.select(PID, x.alias("x")).join(F.broadcast(ends), PID).groupBy(PID, "n", "lo", "hi").agg(
        F.count_if(F.col("x") == F.col("lo")).alias("n_lo"), F.count_if(F.col("x") == F.col("hi")).alias("n_hi"))
    start: dict = {}
    total: dict = {}
    offsets, before = {}, 0
    borders = sorted(held.collect(), key=lambda r: r[PID])  # one row per range partition
    for r in borders:
        offsets[r[PID]] = before
        for v, at, k in {r.lo: (r.lo, before, r.n_lo), r.hi: (r.hi, before + r.n - r.n_hi, r.n_hi)}.values():
            start.setdefault(v, at)
            total[v] = total.get(v, 0) + k
        before += r.n
    rank = {v: start[v] + (total[v] + 1) / 2 for v in start}
    schema = T.StructType([T.StructField(PID, T.IntegerType(), False), *[T.StructField(c, T.LongType()) for c in ("__offset", "__n")],
                           *[T.StructField(c, kind) for c in ("__lo", "__hi")], *[T.StructField(c, T.DoubleType()) for c in ("__lo_rank", "__hi_rank")]])
    table = df.sparkSession.createDataFrame([(r[PID], offsets[r[PID]], r.n, r.lo, r.hi, rank[r.lo], rank[r.hi]) for r in borders], schema)
    up = _run_starts(rows.sortWithinPartitions(col), col, BEFORE)
    both = _run_starts(up.sortWithinPartitions(F.col(col).desc()), col, AFTER).join(F.broadcast(table), PID)
    inside = F.col("__offset") + (F.col(BEFORE) + F.col("__n") - 1 - F.col(AFTER)) / 2.0 + 1.0
    value = F.when(x == F.col("__lo"), F.col("__lo_rank")).when(x == F.col("__hi"), F.col("__hi_rank")).otherwise(inside)
    done = both.select(*df.columns, value.alias(name))
    return done.unionByName(df.where(~ranked).withColumn(name, F.lit(None).cast("double"))), before


def descents(df: DataFrame, key: str, order: Sequence[str], num_partitions: int | None = None) -> tuple[int, int]:
    """Rows with a ``key``, and how many of them have a smaller key than the row before them in ``order`` (unique).

    One range exchange; each partition gives its own count and its first and last key, which are compared on the driver."""
    ranged = _ranged(df.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, *order])), order, num_partitions)
    keys = ranged.select(F.col(key).alias("k"), F.spark_partition_id().alias(PID))
    kind = keys.schema["k"]

    def run(batches):
        n = down = 0
        pid = first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(0).to_numpy(zero_copy_only=False)
            if n == 0:
                pid, first = batch.column(1)[0], batch.column(0)[0]
            else:
                down += int(k[0] < last)
            down += int((k[1:] < k[:-1]).sum())
            n, last, end = n + len(k), k[-1], batch.column(0)[len(k) - 1]
        if n:
            columns = [[pid.as_py()], [n], [down], [first.as_py()], [end.as_py()]]
            types = [pa.int32(), pa.int64(), pa.int64(), first.type, first.type]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [PID, "n", "down", "first", "last"])

    schema = T.StructType([T.StructField(PID, T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("down", T.LongType()),
                           T.StructField("first", kind.dataType), T.StructField("last", kind.dataType)])
    parts = sorted(keys.mapInArrow(run, schema).collect(), key=lambda r: r[PID])  # one row per range partition
    return sum(r.n for r in parts), sum(r.down for r in parts) + sum(b["first"] < a["last"] for a, b in zip(parts, parts[1:]))
