"""Mergeable sketches against exact counts."""

from pyspark.sql import functions as F

from textloom.functions.text import words
from textloom.operators import sketches
from textloom.plans import load_all
from textloom.plans.registry import QUERIES
from textloom.sources.scratch import durable

FOLDER = "/root/testdata/sf0.001"


def _numbers(spark):
    """60,000 distinct values; two thirds of the rows are in one group, and values stand in several groups."""
    rows = spark.range(180_000).select((F.col("id") % 60_000).cast("string").alias("value"), "id")
    group = F.when(F.col("id") < 120_000, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 4).cast("string")))
    return rows.withColumn("g", group).withColumn("day", F.col("id") % 3)


def test_stored_sketches_merge_within_the_stated_error(spark):
    df = _numbers(spark)
    stored = durable(sketches.sketched(df, ["g", "day"], "value"))
    for group in (["g"], ["day"], []):
        exact = df.groupBy(*group).agg(F.count("*").alias("rows"), F.count_distinct("value").alias("exact"))
        found = sketches.distinct_counts(sketches.merged(stored, group), group)
        both = [(e, f) for e in exact.collect() for f in found.collect() if all(e[c] == f[c] for c in group)]
        assert len(both) == exact.count()
        for e, f in both:
            assert f.n == e.rows
            assert abs(f.approx_distinct - e.exact) <= 0.025 * e.exact


def test_frequent_values_of_a_few_are_exact(spark):
    df = spark.range(9_000).select((F.col("id") % 3).alias("g"), F.sqrt(F.col("id") / 3).cast("int").cast("string").alias("value"))
    stored = durable(sketches.sketched(df, ["g"], "value"))
    exact = {(r.g, r.value): r["count"] for r in df.groupBy("g", "value").count().collect()}
    found = sketches.frequent_values(stored, ["g"], 5).collect()
    assert len(found) == 15
    assert all(r.approx_count == exact[r.g, r.item] for r in found)
    for g in range(3):
        assert sorted(r.approx_count for r in found if r.g == g) == sorted(n for (h, _), n in exact.items() if h == g)[-5:]


def test_queries_against_exact_counts(spark):
    load_all()
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("source", "lang", F.explode(words(F.col("text"))).alias("word"))
    exact = {}
    for level, group in (("source, lang", ["source", "lang"]), ("source", ["source"]), ("all", [])):
        for r in rows.groupBy(*group).agg(F.count("*").alias("n"), F.count_distinct("word").alias("d")).collect():
            exact[level, r["source"] if "source" in group else None, r["lang"] if "lang" in group else None] = (r.n, r.d)
    found = {(r.level, r.source, r.lang): r for r in QUERIES["a23_sketch_counts"](spark, FOLDER).collect()}
    assert found.keys() == exact.keys()
    for key, (n, distinct) in exact.items():
        assert found[key].n_words == n
        assert abs(found[key].approx_distinct - distinct) <= 0.025 * distinct
    top = QUERIES["a23_frequent_words"](spark, FOLDER).collect()
    counts = {(r["source"], r.word): r["count"] for r in rows.groupBy("source", "word").count().collect()}
    assert all(abs(r.approx_count - counts[r["source"], r.item]) <= 0.01 * exact["source", r["source"], None][0] for r in top)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y"), (None, "y")], "g string, value string")
    stored = durable(sketches.sketched(df, ["g"], "value"))
    assert {tuple(r) for r in sketches.distinct_counts(stored, ["g"]).collect()} == {("a", 1, 1), (None, 2, 1)}
    assert sketches.sketched(df.limit(0), ["g"], "value").count() == 0
