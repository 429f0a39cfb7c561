"""A corpus from raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import mixing, packing, quality, secret_scan, simhash
from textloom.llm.common import Stored
from textloom.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that a base rule or the line rules reject."""
    rows = quality.quality_rules(docs)
    # A filter would be pushed below the rules, and their columns computed anew inside each other; a generator is not.
    rows = rows.withColumn("__kept", F.explode(F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))))
    rows = rows.withColumn("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8."""
    return simhash.drop_near_duplicates(docs, shingle=5, similarity=0.8)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row for each piece of a document."""
    # Smaller tasks that remember fewer words than op4's: executors that ran the other stages have less memory left.
    placed = packing.best_fit_sequences(docs, tokenizer_path(), capacity=1024, task_bytes=64 << 20, most_known=600_000)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # tokenizers, fingerprints and packing are not SQL; tests/llm has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir), name).df
    return docs
