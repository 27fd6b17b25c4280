"""Output conventions shared by the driver queries: round every DOUBLE to 6
places and turn zone-free timestamps into epoch microseconds, so both engines
produce the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def epoch_us(col: str) -> F.Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            out.append(epoch_us(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
