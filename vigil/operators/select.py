"""Exact selection without a sort: order statistics, quantiles and rows at positions.

The value at a position is found by range histograms. A round counts, for every
interval that still holds a wanted position, the rows in each of ``BUCKETS`` ranges
of it (a grouped aggregate with map-side combine, so a task sends at most a row per
range), and keeps the ranges with wanted positions, shrunk to the values they hold.
An interval with one value, or with at most ``FEW`` rows, needs no further round:
the rows of all such intervals are counted by value in the end, at most ``FEW``
values each. There is one path at every size, groups are rows of the state and not
of the driver, and everything runs in the JVM.

Ranges of doubles are equal parts of a logarithmic scale while an interval spans
more than a factor of e (so one outlier does not leave all others in one range),
equal parts of the interval after that; of integers, equal upper bits. Both are
monotone in the value, so counts before a range are counts of smaller values.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint

BUCKETS = 4096
FEW = 1 << 17             # rows of an interval that are counted by value
BROADCAST_ROWS = 10_000   # intervals that a driver holds and broadcasts; more are a written table, joined by group
LARGEST = 1.7976931348623157e308
EPOCH = dt.datetime(1970, 1, 1)


def _scale(x: Column) -> Column:
    """A monotone logarithmic scale for all doubles."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.least(F.ln(F.abs(x)), F.lit(710.0)) + 750.0))


def _double_bucket() -> Column:
    x, lo, hi = (F.greatest(F.least(F.col(c), F.lit(LARGEST)), F.lit(-LARGEST)) for c in ("x", "lo", "hi"))
    sx, slo, shi = (_scale(F.col(c)) for c in ("x", "lo", "hi"))
    part = F.when(shi - slo > 1.0, F.try_divide(sx - slo, shi - slo)).otherwise(F.try_divide(x - lo, hi - lo))
    return F.least(F.floor(F.coalesce(part, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1).cast("long"))


def _integer_bucket() -> Column:
    bits = f"cast(greatest(0, ceil(log2((cast(hi as double) - cast(lo as double)) / {BUCKETS}))) as int)"
    return F.expr(f"shiftright(x, {bits}) - shiftright(lo, {bits})")


STATE = ["g", "c", "total", "lo", "hi", "n", "before", "pos"]


@dataclass
class Intervals:
    """The state of a selection, computed once: with few intervals from rows that the driver holds, else a written table."""

    table: DataFrame
    n_open: int     # that need another round
    n_several: int  # that hold several values


def _local(spark: SparkSession, rows: list, schema: T.StructType) -> Intervals:
    at = {f: schema.fieldNames().index(f) for f in ("lo", "hi", "n")}
    several = [r for r in rows if r[at["lo"]] is None or r[at["lo"]] < r[at["hi"]]]
    return Intervals(spark.createDataFrame(rows, schema), sum(r[at["n"]] > FEW for r in several), len(several))


def _held(state: DataFrame) -> Intervals:
    state = state.where(F.size("pos") > 0).select(STATE)
    rows = state.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) <= BROADCAST_ROWS:
        return _local(state.sparkSession, rows, state.schema)
    state = checkpoint(state)
    return Intervals(state, *state.agg(F.count_if(_several() & (F.col("n") > FEW)), F.count_if(_several())).first())


def _schema(group: T.DataType, integers: bool) -> T.StructType:
    x, n = T.LongType() if integers else T.DoubleType(), T.LongType()
    kinds = [group, T.IntegerType(), n, x, x, n, n, T.ArrayType(n)]
    return T.StructType([T.StructField(c, k) for c, k in zip(STATE, kinds)])


def _several() -> Column:
    return F.col("lo").isNull() | (F.col("lo") < F.col("hi"))


def _joined(rows: DataFrame, intervals: DataFrame, n: int) -> DataFrame:
    """Rows with the interval of their group and column that holds them (without bounds, the whole group)."""
    both = rows.join(F.broadcast(intervals) if n <= BROADCAST_ROWS else intervals, ["g", "c"])
    return both.where(F.col("x").isNotNull() & (F.col("lo").isNull() | (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))))


def values_at(rows: DataFrame, state: DataFrame | Intervals, integers: bool = False, held_rows: bool = False) -> DataFrame:
    """Values at 0-based positions in the order of ``x`` within each (g, c).

    ``rows``: g, c, x; null x counts nowhere. ``state``: of each (g, c) the count
    ``total``, the bounds lo and hi of x, and ``pos``, an array of positions; groups of
    at most ``FEW`` rows may have null bounds. ``held_rows``: the rows are held already. Returns g, c, total, pos, value, below
    (the number of rows with smaller values) and ties (with that value)."""
    held = state if isinstance(state, Intervals) else _held(state.withColumns({"n": F.col("total"), "before": F.lit(0).cast("long")}))
    if held.n_open and not held_rows:
        rows = checkpoint(rows)
    while held.n_open:
        state = held.table
        open_ = _several() & (F.col("n") > FEW)
        inside = _joined(rows, state.where(open_), held.n_open)
        # the largest value is a range of its own, so every round narrows
        bucket = F.when(F.col("x") >= F.col("hi"), F.lit(BUCKETS).cast("long")).otherwise(_integer_bucket() if integers else _double_bucket())
        cells = inside.groupBy("g", "c", "before", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("low"), F.max("x").alias("high"))
        cells = _located(cells, state.where(open_), "bucket", held.n_open).where(F.size("hit") > 0)  # BUCKETS + 1 ranges at most
        narrowed = cells.select("g", "c", "total", F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("m").alias("n"), F.col("below").alias("before"), F.col("hit").alias("pos"))
        held = _held(state.where(~open_).unionByName(narrowed))
    state = held.table
    single = state.where(~_several()).select("g", "c", "total", F.explode("pos").alias("pos"), F.col("lo").alias("value"), F.col("before").alias("below"), F.col("n").alias("ties"))
    if not held.n_several:
        return single
    several = state.where(_several())
    counts = _joined(rows, several, held.n_several).groupBy("g", "c", "before", "x").agg(F.count(F.lit(1)).alias("m"))
    counts = _located(counts, several, "x", held.n_several)  # FEW values at most
    return single.union(counts.select("g", "c", "total", F.explode("hit").alias("pos"), F.col("x").alias("value"), "below", F.col("m").alias("ties")))


def _located(counts: DataFrame, intervals: DataFrame, order: str, n: int) -> DataFrame:
    """``counts`` (m rows by g, c, before and ``order``) with below, the rows before them, and hit, the positions among them."""
    ahead = F.sum("m").over(Window.partitionBy("g", "c", "before").orderBy(order)) - F.col("m")
    whose = intervals.select("g", "c", "before", "total", "pos")
    both = counts.withColumn("below", F.col("before") + ahead).join(F.broadcast(whose) if n <= BROADCAST_ROWS else whose, ["g", "c", "before"])
    return both.withColumn("hit", F.filter("pos", lambda p: (p >= F.col("below")) & (p < F.col("below") + F.col("m"))))


def _group(by: Sequence[str]) -> Column:
    return F.struct(*(F.col(b) for b in by)) if by else F.struct(F.lit(0).alias("all"))


def _places(total: int, probs: Sequence[float]) -> list[int]:
    return sorted({int(f(p * (total - 1))) for p in probs for f in (math.floor, math.ceil)})


def _hits(df: DataFrame, cols: list[str], probs: list[float], by: list[str], extra: dict, hold: bool = False, held: bool = False) -> tuple[DataFrame, DataFrame | list, DataFrame | None]:
    """Order statistics around the quantiles, and of each group the rows of the first pass: g, s, and the aggregates ``extra``.

    With ``hold`` the rounds read the columns from memory or disk; the third result is what the caller then lets go.
    With ``held`` the caller holds ``df`` that way already."""
    spark = df.sparkSession
    narrow = df.withColumns({"_g": _group(by), **{f"_x{i}": F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for i, c in enumerate(cols)}})
    # one pass for counts, bounds and what else is asked for
    bounds = [F.struct(F.lit(i).alias("c"), F.count(f"_x{i}").alias("total"), F.min(f"_x{i}").alias("lo"), F.max(f"_x{i}").alias("hi")) for i in range(len(cols))]
    first = narrow.groupBy(F.col("_g").alias("g")).agg(F.array(*bounds).alias("s"), *[e.alias(f"_e_{k}") for k, e in extra.items()])
    rows = first.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) <= BROADCAST_ROWS:
        state: DataFrame | Intervals = _local(spark, [(r.g, s.c, s.total, s.lo, s.hi, s.total, 0, _places(s.total, probs)) for r in rows for s in r.s if s.total],
                                              _schema(first.schema["g"].dataType, False))
        done: DataFrame | list = rows
    else:
        done = checkpoint(first)
        places = F.array_distinct(F.array(*[f(_place(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]))
        state = done.select("g", F.explode("s").alias("s")).select("g", "s.*").where("total > 0").withColumn("pos", places)
    flat = narrow.select("_g", *[f"_x{i}" for i in range(len(cols))])
    if hold:
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)
    long = flat.select(F.col("_g").alias("g"), F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_x{i}").alias("x")) for i in range(len(cols))])).alias("s"))
    return values_at(long.select("g", "s.c", "s.x"), state, held_rows=hold or held), done, flat if hold else None


def _place(p: float) -> Column:
    return F.lit(p) * (F.col("total") - 1).cast("double")


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), extra: dict | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of each group: ``by``, ``<col>`` = array of the quantiles at ``probs``,
    and the aggregates ``extra`` (name -> aggregate).

    Nulls and NaN are ignored; a column without values in a group is null there."""
    cols, by, extra, probs = list(cols), list(by), dict(extra or {}), [float(p) for p in probs]
    hits, first, _ = _hits(df, cols, probs, by, extra)
    at = hits.groupBy("g", "c").agg(F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("pos", "value"))).alias("at"))

    def quantile(p: float) -> Column:
        lo, hi = (F.col("at")[f(_place(p)).cast("long")] for f in (F.floor, F.ceil))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (_place(p) - F.floor(_place(p))))

    found = at.select(F.col("g").alias("fg"), "c", F.array(*map(quantile, probs)).alias("q"))
    found = found.groupBy("fg").agg(*[F.max(F.when(F.col("c") == i, F.col("q"))).alias(f"q{i}") for i in range(len(cols))])
    if isinstance(first, list):
        schema = T.StructType([hits.schema["g"], *[T.StructField(f"_e_{k}", T.DoubleType()) for k in extra]])
        first = df.sparkSession.createDataFrame([(r.g, *[None if r[f"_e_{k}"] is None else float(r[f"_e_{k}"]) for k in extra]) for r in first], schema)
    both = first.join(found, F.col("g") == F.col("fg"), "left")
    return both.select(*[F.col("g")[b].alias(b) for b in by], *[F.col(f"q{i}").alias(c) for i, c in enumerate(cols)], *[F.col(f"_e_{k}").cast("double").alias(k) for k in extra])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), extra: dict | None = None, held: bool = False) -> dict:
    """``quantile_table`` as ``{group: {col: quantiles}}`` (group ``()`` without ``by``), for parameters that a
    driver keeps; a column without values has ``None``. ``extra`` (name -> aggregate) is added per group as ``"extra"``.

    ``held``: the caller holds ``df`` in memory or on disk, so no copy of its columns is."""
    cols, probs, by, extra = list(cols), [float(p) for p in probs], list(by), dict(extra or {})
    hits, first, copy = _hits(df, cols, probs, by, extra, hold=not held, held=held)
    first = first if isinstance(first, list) else first.collect()
    at = {(tuple(r.g), r.c, r.pos): r.value for r in hits.collect()} if first else {}
    if copy is not None:
        copy.unpersist()

    def quantile(g: tuple, c: int, total: int, p: float) -> float | None:
        if not total:
            return None
        place = p * (total - 1)
        lo, hi = at[g, c, math.floor(place)], at[g, c, math.ceil(place)]
        return lo if lo == hi else lo + (hi - lo) * (place - math.floor(place))

    out: dict = {} if by else {(): {c: [None] * len(probs) for c in cols}}
    for r in first:
        out[tuple(r.g) if by else ()] = {cols[s.c]: [quantile(tuple(r.g), s.c, s.total, p) for p in probs] for s in r.s}
        if extra:
            out[tuple(r.g) if by else ()]["extra"] = {k: r[f"_e_{k}"] for k in extra}
    if extra and not by and not first:  # no rows
        out[()]["extra"] = df.agg(*[e.alias(k) for k, e in extra.items()]).first().asDict()
    return out


def quantile_map(df: DataFrame, col: str, probs: Sequence[float]) -> dict[float, float]:
    return dict(zip(map(float, probs), exact_quantiles(df, [col], probs)[()][col]))


def _as_number(df: DataFrame, name: str) -> tuple[Column, bool, Callable]:
    """A column as double or long with the same order, whether it is long, and the way back for a value."""
    kind, x = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)"), True, lambda v: EPOCH + dt.timedelta(microseconds=v)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x), True, lambda v: dt.datetime.fromtimestamp(0) + dt.timedelta(microseconds=v)
    if isinstance(kind, T.DateType):
        return F.unix_date(x).cast("long"), True, lambda v: EPOCH.date() + dt.timedelta(days=v)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return x.cast("long"), True, int
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return x.cast("double"), False, float
    raise TypeError(f"rows can't be selected by {name}: {kind.simpleString()}")


def rows_at(df: DataFrame, order: Sequence[str], positions: Callable[[int], Sequence[int]]) -> tuple[int, dict[int, tuple]]:
    """Keys of the rows at 0-based positions in the lexicographic order of the columns ``order`` (unique, without nulls).

    ``positions`` turns the row count into positions; returns the count and the keys by position. The first key is
    selected over all rows, each next one among the rows that agree in the keys before."""
    order = list(order)
    numbers = [_as_number(df, c) for c in order]
    keys = checkpoint(df.select(*[x.alias(f"k{i}") for i, (x, _, _) in enumerate(numbers)]))
    n, *edges = keys.agg(F.count(F.lit(1)), F.min("k0"), F.max("k0")).first()
    found = {p: ((), p) for p in sorted({int(p) for p in positions(n) if 0 <= p < n})}  # keys so far, position among the rows that have them
    ties = dict.fromkeys([()], n)
    for i, (_, integers, _) in enumerate(numbers):
        starts = list(dict.fromkeys(at for at, _ in found.values()))  # one per position at most
        if not starts:
            break
        g = F.lit(None).cast("int")
        for k, start in enumerate(starts):
            here = F.lit(True)
            for j, v in enumerate(start):
                here = here & (F.col(f"k{j}") == F.lit(v))
            g = F.when(here, F.lit(k)).otherwise(g)
        rows = keys.select(g.alias("g"), F.lit(0).alias("c"), F.col(f"k{i}").alias("x")).where(F.col("g").isNotNull())
        pos = [sorted({rest for at, rest in found.values() if at == start}) for start in starts]
        bounds = {0: tuple(edges)} if i == 0 else dict.fromkeys(range(len(starts)), (None, None))
        if i and max(ties[start] for start in starts) > FEW:
            bounds = {r.g: (r.lo, r.hi) for r in rows.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
        state = _local(df.sparkSession, [(k, 0, ties[start], *bounds[k], ties[start], 0, pos[k]) for k, start in enumerate(starts)], _schema(T.IntegerType(), integers))
        hits = {(starts[r.g], r.pos): r for r in values_at(rows, state, integers).collect()}
        ties = {(*at, r.value): r.ties for (at, _), r in hits.items()}
        found = {p: ((*at, hits[at, rest].value), rest - hits[at, rest].below) for p, (at, rest) in found.items()}
    return n, {p: tuple(back(v) for v, (_, _, back) in zip(at, numbers)) for p, (at, _) in found.items()}
