"""Rows of words in a given number of partitions, whatever the session's number: same results, and tasks of bounded size."""

from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import texts

ROWS = [(k, " ".join(f"w{(k * i) % 7} common" for i in range(9)) + f". w{k % 5} w{k}") for k in range(40)] + [(3, "w1 common"), (None, "w2"), (41, None)]
WORDS = [(f"w{i}", f"v{i}") for i in range(0, 40, 2)] + [("common", "c")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replaced_words(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    mapping = spark.createDataFrame(WORDS, "word string, replacement string")
    one, parts = (texts.replace_words(docs, "doc_id", tx.words(F.col("text")), mapping, "w", n) for n in (None, 13))
    read = lambda df: sorted((str(r.doc_id), r.w) for r in df.collect())
    assert read(one) == read(parts) and "hashpartitioning(doc_id" in _plan(parts) and ", 13)" in _plan(parts)


def test_mentions(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    gazetteer = spark.createDataFrame(WORDS, "word string, type string")
    found = [texts.mentions(docs, "doc_id", tx.sentences(F.col("text")), gazetteer, tx.words, n) for n in (None, 13)]
    one, parts = (sorted(map(str, texts.mention_runs(f, "doc_id").collect())) for f in found)
    assert one == parts and len(one) > 40
    runs = _plan(texts.mention_runs(found[1], "doc_id"))
    assert ", 13)" in runs and "ENSURE_REQUIREMENTS" not in runs.split("Window")[1].split("Join")[0]
