"""Prepared tables shared by the driver queries: cleaned card/shop tables with
row ids, time splits, fitted feature models and feature tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.clean import clean
from vigil.operators.features import FeatureModel, FittedFeatures
from vigil.operators.rank import global_rank, leaf_bytes
from vigil.operators.split import split_2way, split_3way, split_ranked
from vigil.session import stored
from vigil.sources.fixtures import SHOP_KEY, card, shop

SHOP_RANK_KEY = ["transaction_date", *SHOP_KEY]
SHOP_PARTS = 4           # more would read the line items more often
PART_BYTES = 128 << 20   # of the tables' files; smaller tables are one part
SORT_ROWS = 1 << 20      # of a task's sort, about 200 MB


def clean_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(card(spark, sf_dir))


def _parts(raw: DataFrame) -> int:
    """In how many parts a table is joined and sorted: their shuffles follow each other on the disk."""
    return max(1, min(SHOP_PARTS, math.ceil((leaf_bytes(raw) or 0) / PART_BYTES)))


def clean_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned shop table; ``row_id`` is the position in (date, line-item key) order.

    The joined table is written while its caps and ranges are found and it is ranked, so the joins run once."""
    raw = shop(spark, sf_dir, keep_keys=True)
    k = _parts(raw)
    held, remove = stored([lambda: raw] if k == 1 else [lambda i=i: shop(spark, sf_dir, keep_keys=True, part=(i, k)) for i in range(k)])
    try:
        df = clean(held, held=True)
        keys = [c for c in SHOP_KEY if c != "quantity"]
        n = max(spark.sparkContext.defaultParallelism, math.ceil(held.count() / SORT_ROWS))
        ranked = global_rank(df, SHOP_RANK_KEY, "row_id", n, drop=keys, parts=k)
    finally:
        remove()
    return ranked.select("row_id", *[c for c in df.columns if c not in keys])


def card_split(spark, sf_dir, flow: str = "80_20") -> DataFrame:
    df = clean_card(spark, sf_dir)
    if flow == "80_10_10":
        return split_3way(df)
    return split_2way(df, 0.9 if flow == "90_10" else 0.8)


def shop_split(spark, sf_dir, flow: str = "80_20") -> DataFrame:
    df = clean_shop(spark, sf_dir)
    if flow == "80_10_10":
        return split_ranked(df, [0.8, 0.1], ["train", "val", "test"])
    return split_ranked(df, [0.9 if flow == "90_10" else 0.8], ["train", "test"])


def fit_features(split_df: DataFrame, held: bool = False, **kw) -> FittedFeatures:
    return FeatureModel(**kw).fit(split_df.where(F.col("split") == "train").drop("split"), held=held)


def feature_table(split_df: DataFrame, fitted: FittedFeatures | None = None,
                  keep=("row_id", "split", "is_fraudulent"), **kw) -> tuple[FittedFeatures, DataFrame]:
    """Fit on the train rows, transform every split with per-split batch statistics."""
    fitted = fitted or fit_features(split_df, **kw)
    return fitted, fitted.transform(split_df, batch_col="split", keep=keep)


def card_features(spark, sf_dir, flow: str = "80_20", **kw):
    return feature_table(card_split(spark, sf_dir, flow), **kw)


def shop_features(spark, sf_dir, flow: str = "80_20", **kw):
    return feature_table(shop_split(spark, sf_dir, flow), held=True, **kw)
