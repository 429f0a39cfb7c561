"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.hashing import HASH_SPACE, hash_key
from textloom.functions.text import https_links
from textloom.operators.splits import ratio_split
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query
from textloom.sources import readers, writers
from textloom.sources.scratch import new_path

SEED = 42


def _flat(text):
    return F.regexp_replace(text, r"[\t\r\n]+", " ")


@query(
    "s1_tsv_scan",
    f"""SELECT doc_id, lang, source, n_chars, {q.strip('text', '[\\t\\r\\n]+', ' ')} AS text FROM documents""",
)
def tsv_scan(t):
    rows = t.documents.select("doc_id", "lang", "source", "n_chars", _flat(F.col("text")).alias("text"))
    path = writers.write_delimited(rows, new_path(t.spark, "tsv"), sep="\t")
    return readers.read_delimited(t.spark, path, rows.schema, sep="\t", ignoreLeadingWhiteSpace=False)


@query(
    "s2_json_lines_scan",
    "SELECT doc_id, text AS headline, lang FROM documents WHERE lang NOT IN ('es', 'de')",
)
def json_lines_scan(t):
    """German rows lack the text field and Spanish lines are cut off; both are skipped."""
    full = F.to_json(F.struct("doc_id", F.col("text").alias("headline"), "lang"))
    line = (
        F.when(F.col("lang") == "es", F.substring(full, F.lit(1), F.length(full) - 5))
        .when(F.col("lang") == "de", F.to_json(F.struct("doc_id", "lang")))
        .otherwise(full)
    )
    path = writers.write_json_lines(t.documents.select(line.alias("value")), new_path(t.spark, "jsonl"))
    schema = T.StructType.fromDDL("doc_id bigint, headline string, lang string")
    return readers.read_json_lines(t.spark, path, schema, required=["headline"])


@query("s3_csv_files_with_column", "SELECT text AS lyrics FROM documents WHERE lang <> 'fr'")
def csv_files_with_column(t):
    """Files of French documents lack the wanted column and are left out."""
    flagged = t.documents.withColumn("part", F.when(F.col("lang") == "fr", "without").otherwise("with"))
    root = new_path(t.spark, "csvset")
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for part, name in (("with", "lyrics"), ("without", "body")):
        rows = flagged.filter(F.col("part") == part).select("doc_id", F.col("text").alias(name))
        writers.write_table(rows, f"{root}/{part}", fmt="csv", **options)
    found, _ = readers.read_csv_with_column(
        t.spark, [f"{root}/with", f"{root}/without"], "lyrics", multiLine=True, escape='"', ignoreLeadingWhiteSpace=False
    )
    return found


@query("s4_text_file_scan", "SELECT item_id::VARCHAR AS id, text FROM benchmark")
def text_file_scan(t):
    path = writers.write_table(t.benchmark.select("item_id", "text"), new_path(t.spark, "txt"), ["item_id"], "text")
    files = readers.read_text_files(t.spark, path, id_pattern=r"item_id=(\d+)/")
    return files.withColumn("text", F.regexp_replace("text", r"\n$", ""))


@query(
    "s5_percent_slices",
    """
    WITH n AS (SELECT count(*) AS n FROM documents),
    i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
    SELECT CASE WHEN row_idx < n * 2 // 100 THEN 'head' WHEN row_idx >= n * 99 // 100 THEN 'tail' END AS slice,
           doc_id, row_idx
    FROM i, n WHERE row_idx < n * 2 // 100 OR row_idx >= n * 99 // 100
    """,
)
def percent_slices(t):
    ids = t.documents.select("doc_id")
    head = readers.percent_slice(ids, "doc_id", 0, 2).withColumn("slice", F.lit("head"))
    tail = readers.percent_slice(ids, "doc_id", 99, 100).withColumn("slice", F.lit("tail"))
    return head.unionByName(tail)


@query(
    "s6_scan_sample",
    f"SELECT event_id, event_type, value FROM events WHERE {q.hash_key('event_id', SEED)} < {int(0.004 * HASH_SPACE)}",
)
def scan_sample(t):
    """Keeps each row with probability 0.004 and reads only three columns."""
    keep = hash_key(F.col("event_id"), SEED) < int(0.004 * HASH_SPACE)
    return t.events.select("event_id", "event_type", "value").filter(keep)


@query(
    "s7_take_then_skip",
    """
    SELECT CASE WHEN i < 9000 THEN 'train' ELSE 'validation' END AS split, event_id, i AS row_idx
    FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events) WHERE i < 10000
    """,
)
def take_then_skip(t):
    ids = readers.row_range(t.events.select("event_id"), "event_id", 0, 10_000)
    return ids.withColumn("split", F.when(F.col("row_idx") < 9000, "train").otherwise("validation"))


_SPLIT_SQL = f"""
    SELECT *, CASE WHEN {q.hash_key('doc_id', SEED)} < {int(0.8 * HASH_SPACE)} THEN 'train'
                   WHEN {q.hash_key('doc_id', SEED)} < {int(0.9 * HASH_SPACE)} THEN 'validation'
                   ELSE 'test' END AS split
    FROM documents"""


def _split_documents(t):
    return ratio_split(t.documents, "doc_id", {"train": 0.8, "validation": 0.1, "test": 0.1}, SEED)


@query("s8_partitioned_sink", f"SELECT split, doc_id, lang, text FROM ({_SPLIT_SQL})")
def partitioned_sink(t):
    path = writers.write_table(_split_documents(t), new_path(t.spark, "dataset"), ["split"])
    return t.spark.read.parquet(path).select("split", "doc_id", "lang", "text")


@query(
    "s9_word_vector_scan",
    """SELECT 'w' || vec_id AS word, len(embedding)::INTEGER AS dims,
              array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1e9)::BIGINT), ',') AS billionths FROM embeddings""",
)
def word_vector_scan(t):
    """Whole vectors, as whole billionths so that engines compare them exactly."""
    line = F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"), F.array_join(F.col("embedding").cast("array<string>"), " "))
    path = writers.write_json_lines(t.embeddings.select(line.alias("value")), new_path(t.spark, "vectors"))
    vectors = readers.parse_word_vectors(t.spark.read.text(path))
    parts = F.transform(F.col("vec").cast("array<float>"), lambda x: F.round(x.cast("double") * 1e9).cast("bigint"))
    return vectors.select("word", F.size("vec").alias("dims"), csv(parts).alias("billionths"))


@query("s10_split_sizes", f"SELECT split, count(*) AS n FROM ({_SPLIT_SQL}) GROUP BY split")
def split_sizes(t):
    return _split_documents(t).groupBy("split").agg(F.count("*").alias("n"))


@query(
    "s11_page_links",
    """
    WITH l AS (
      SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site,
             unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
    a AS (SELECT page_id, CASE WHEN href LIKE '/%' THEN site || href ELSE href END AS link FROM l)
    SELECT page_id, regexp_replace(link, '^https://m\\.', '') AS link, count(*) AS n
    FROM a WHERE link LIKE 'https%' GROUP BY ALL
    """,
)
def page_links(t):
    links = t.pages.select("page_id", F.explode(https_links(F.col("html"), F.col("url"))).alias("link"))
    shown = links.withColumn("link", F.regexp_replace("link", r"^https://m\.", ""))
    return shown.groupBy("page_id", "link").agg(F.count("*").alias("n"))
