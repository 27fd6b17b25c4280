"""Local stand-in for the driver's correctness check: run a Spark query and its
DuckDB oracle on the same Parquet tables and compare row count, column names
and order-insensitive values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from vigil.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count spark={len(s)} oracle={len(d)}"
    rs, rd = frame_rows(s), frame_rows(d)
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(s)} rows match"
