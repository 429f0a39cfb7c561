"""The operators over the given tables, as registered queries with production parameters."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import alignment, manifest, mixing, neighbours, packing, quality, quality_model, secret_scan, simhash, substring, suffix, tokenfile, toxicity
from textloom.llm.common import word_count

FILE_BYTES = 112 << 20  # of text, for each token file

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return os.environ.get("TEXTLOOM_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return os.environ.get("TEXTLOOM_PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark, folder):
    return simhash.simhash_classes(table(spark, folder, "documents"), shingle=3, most_bits=3)


@query
def op2_toxicity(spark, folder):
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_secrets(spark, folder):
    return secret_scan.secret_spans(table(spark, folder, "documents"))


@query
def op4_packing(spark, folder):
    placed = packing.best_fit_sequences(table(spark, folder, "documents"), tokenizer_path(), capacity=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op5_substring(spark, folder):
    found = substring.without_repeats(table(spark, folder, "documents"), window=13, with_kept=False)
    return found.drop("kept")


@query
def op6_mixing(spark, folder):
    docs = table(spark, folder, "documents")
    mixed = mixing.mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_quality(spark, folder):
    rows = quality.quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *counts, "base_failed", "kept")


@query
def op8_neighbours(spark, folder):
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    found = neighbours.nearest(rows, rows.filter(F.col("id") % 100 == 0), k=10)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op9_suffix(spark, folder):
    found = suffix.without_repeated_bytes(table(spark, folder, "documents"), length=200, with_kept=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_token_files(spark, folder):
    docs = table(spark, folder, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    read = tokenfile.token_file_round_trip(docs, tokenizer_path(), max(1, math.ceil(size / FILE_BYTES)))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")



@query
def op11_quality_rules(spark, folder):
    return quality_model.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_alignment(spark, folder):
    found = alignment.align(table(spark, folder, "documents"), tokenizer_path(), piece_model_path())
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_manifest(spark, folder):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return manifest.verified_rows(table(spark, folder, "documents"), tampered, manifest.lower_case(F.col("text")))
