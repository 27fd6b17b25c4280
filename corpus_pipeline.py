"""The training-corpus pipeline: each stage calls one operator of ``vigil.llm`` on what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm import decontaminate, mixing, near_dedup, quality, token_files
from vigil.llm.text import written


#: names of columns within a stage, reserved so that the documents' own columns pass through
KEPT, ROW = "__stage_kept", "__stage_row"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates (one row of repeated rows)."""
    kept = near_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(KEPT)).distinct()
    # joined first, so that the window finds the rows dealt by doc_id already
    one = docs.join(kept, F.col("doc_id") == F.col(KEPT), "left_semi")
    one = one.withColumn(ROW, F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "source"))).where(F.col(ROW) == 1)
    return one.select(docs.columns).union(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.copies(docs).select(docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the token files hold them: doc_id, start, n_tokens, ids_crc32."""
    return token_files.tokens(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mix_sources),
    ("token output", token_output),
]
#: several stages (sketches, tokenizer, permutations) have no SQL form; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
