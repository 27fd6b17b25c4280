"""Fingerprints of tables that do not depend on the order of their rows.

A column's digest is the sum over its rows of the MD5 number of ``key|value``, so it
needs aggregates with map-side combine only, and one changed value, or two values
that changed rows, change it. Values are written exactly and alike in every engine:
doubles as sign, whole part and two parts of 52 binary digits (what lies below
2**-104 is not seen; from 2**63 on in the engine's own notation; -0.0 as 0.0),
timestamps as microseconds, arrays as their elements. Nulls are counted apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.draws import number

PART = float(2 ** 52)
WHOLE = float(2 ** 63)
SUM = "decimal(28,0)"   # 60-bit numbers; their sum is a decimal(38,0)


def _double_text(x: Column) -> Column:
    size = F.abs(x)
    high = (size - F.floor(size)) * PART
    low = (high - F.floor(high)) * PART
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+"))
    exact = F.concat_ws("/", sign, *[F.floor(p).cast("string") for p in (size, high, low)])
    return F.when(F.isnan(x), F.lit("nan")).when(size >= WHOLE, x.cast("string")).otherwise(exact)


def value_text(x: Column, kind: T.DataType) -> Column:
    """The text that stands for a value (null: null)."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(x.isNotNull(), _double_text(x.cast("double")))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), x).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x).cast("string")
    if isinstance(kind, T.ArrayType):
        texts = F.transform(x, lambda e: F.coalesce(value_text(e, kind.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    if isinstance(kind, (T.MapType, T.StructType)):
        raise ValueError(f"no fingerprint of {kind.simpleString()}")
    return x.cast("string")


def _key_text(kinds: dict[str, T.DataType], key: Sequence[str]) -> Column:
    return F.concat(F.lit(""), *[F.concat(F.coalesce(value_text(F.col(f"`{k}`"), kinds[k]), F.lit("")), F.lit("|")) for k in key])


def fingerprints(df: DataFrame, key: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: ``column``, ``n_rows``, ``n_null``, ``digest`` (decimal digits; an empty table's is 0).

    ``key`` names the columns that identify a row; without it a column's values may change rows unseen. Columns of one
    type are stacked and share one expression and one aggregate."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = list(kinds) if columns is None else list(columns)
    row = _key_text(kinds, key)
    by_kind: dict = {}
    for c in columns:
        by_kind.setdefault(kinds[c].simpleString(), []).append(c)
    out = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    found = None
    for names in by_kind.values():
        stacked = df.select(row.alias("k"), F.posexplode(F.array(*[F.col(f"`{c}`") for c in names])).alias("i", "x"))
        text = value_text(F.col("x"), kinds[names[0]])
        part = stacked.groupBy("i").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("x").isNull()).alias("n_null"),
            F.sum(number(F.concat("k", text)).cast(SUM)).cast("string").alias("digest"))
        name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1)
        part = part.select(name.alias("column"), "n_rows", "n_null", "digest")
        found = part if found is None else found.unionByName(part)
    zero = {"n_rows": F.lit(0).cast("long"), "n_null": F.lit(0).cast("long"), "digest": F.lit("0")}
    return out.join(found, "column", "left").select("column", *[F.coalesce(F.col(c), z).alias(c) for c, z in zero.items()])


def _hashed(df: DataFrame, key: Sequence[str], as_is: set[str]) -> DataFrame:
    """Per column: ``column``, ``n_rows``, ``n_null``, ``digest``, as ``fingerprints`` does but for tables that this engine alone
    compares: the sums of two 64-bit hashes of key and value, 60 bits of each, in place of 60 bits of an MD5 of their text.

    Columns ``as_is`` are hashed as they are, the others by their text. A sum holds 2**33 rows."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    by_kind: dict = {}
    for c in kinds:
        by_kind.setdefault((c in as_is, kinds[c].simpleString()), []).append(c)
    rows = df.withColumns({f"__k{s}": F.xxhash64(F.lit(s), _key_text(kinds, key)) for s in (0, 1)})
    out = df.sparkSession.createDataFrame([(c,) for c in kinds], "column string")
    found = None
    for (plain, _), names in by_kind.items():
        stacked = rows.select("__k0", "__k1", F.posexplode(F.array(*[F.col(f"`{c}`") for c in names])).alias("i", "x"))
        value = F.col("x") if plain else value_text(F.col("x"), kinds[names[0]])
        stacked = stacked.select("i", F.col("x").isNull().alias("null"), *[
            F.when(F.col("x").isNotNull(), F.xxhash64(f"__k{s}", value)).alias(f"h{s}") for s in (0, 1)])
        low = F.lit((1 << 30) - 1).cast("long")
        sums = [F.sum(half).cast("string") for h in ("h0", "h1") for half in (F.col(h).bitwiseAND(low), F.shiftrightunsigned(h, 34))]
        part = stacked.groupBy("i").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("null").alias("n_null"), F.concat_ws(":", *sums).alias("digest"))
        name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1)
        part = part.select(name.alias("column"), "n_rows", "n_null", "digest")
        found = part if found is None else found.unionByName(part)
    zero = {"n_rows": F.lit(0).cast("long"), "n_null": F.lit(0).cast("long"), "digest": F.lit("")}
    return out.join(found, "column", "left").select("column", *[F.coalesce(F.col(c), z).alias(c) for c, z in zero.items()])


#: types whose hash tells values apart as their texts do (of arrays it skips nulls)
HASHED = (T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.StringType, T.DateType, T.TimestampType,
          T.TimestampNTZType, T.DecimalType)


def compare(left: DataFrame, right: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Per column of either table: ``column``, ``n_rows`` (of the left one; null where it lacks the column) and ``same``.

    Columns of one type in both tables are compared by hashes of their values, others by hashes of their texts."""
    kinds = {f.name: f.dataType for f in left.schema.fields}
    as_is = {f.name for f in right.schema.fields if kinds.get(f.name) == f.dataType and isinstance(f.dataType, HASHED)}
    b = _hashed(right, key, as_is).select("column", *[F.col(c).alias(f"r_{c}") for c in ("n_rows", "n_null", "digest")])
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ("n_rows", "n_null", "digest")]
    return _hashed(left, key, as_is).join(b, "column", "full").select("column", "n_rows", (same[0] & same[1] & same[2]).alias("same"))
