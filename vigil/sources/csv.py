"""CSV source (A1) with a declared schema, parsed dates (B8), a column check (B11) and a bad-record channel.

Types are never inferred from the rows. The header, normalised as in B1, gives the order of the columns; a column that
the declaration lacks is text. The file is parsed once, in permissive mode, into the shared folder, so good and bad
records are read from the same parse.

Defined results: an empty field is null; a record with a field that does not fit its type, or with too many or too few
fields, is bad and carried whole as text; a file with a header alone gives an empty table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.clean import ID_COLUMNS, V_COLUMNS, is_card, missing_v_columns
from vigil.session import ensure_checkpoint_dir

BAD = "__bad_record"
DATE_FORMAT = "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]"
# fixed values: the raw columns of the two table shapes
CARD_TYPES = {"row_id": T.LongType(), "time": T.DoubleType(), **{v: T.DoubleType() for v in V_COLUMNS}, "amount": T.DoubleType(),
              "class": T.IntegerType(), "is_fraudulent": T.IntegerType()}
SHOP_TYPES = {"transaction_date": T.TimestampNTZType(), "transaction_amount": T.DoubleType(), "quantity": T.DoubleType(),
              "customer_age": T.IntegerType(), "account_age_days": T.IntegerType(), "is_fraudulent": T.IntegerType(),
              **{c: T.StringType() for c in ("customer_location", "payment_method", "product_category", "device_used", *ID_COLUMNS)}}


@dataclass
class CsvTable:
    rows: DataFrame          # good records, typed
    bad: DataFrame           # record: the text of each bad record
    missing: list[str]       # expected v columns that the header lacks (card shape)


def read_csv(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None) -> CsvTable:
    """The records of a CSV file or folder with a header; ``types`` declares the columns (default: both table shapes)."""
    types = {**SHOP_TYPES, **CARD_TYPES} if types is None else types
    header = [c.lower().replace(" ", "_") for c in spark.read.option("header", True).csv(path).columns]
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in header]
    raw = (spark.read.schema(T.StructType([*fields, T.StructField(BAD, T.StringType())]))
           .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", BAD).option("timestampNTZFormat", DATE_FORMAT).csv(path))
    parsed = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    raw.write.parquet(parsed)
    table = spark.read.schema(raw.schema).parquet(parsed)
    good = table.where(F.col(BAD).isNull()).drop(BAD)
    return CsvTable(good, table.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("record")), missing_v_columns(good) if is_card(good) else [])
