"""Queries that return whole texts and whole vectors, against plain versions."""

from pyspark.sql import functions as F

from textloom.functions.stemming import stem_word, stem_words
from textloom.operators import prompts
from textloom.plans import load_all
from textloom.plans.registry import QUERIES

load_all()


def test_full_cleaning_ends_with_the_stems_of_the_kept_words(spark, tables):
    from tests.conftest import SF

    words = {r.doc_id: r.cleaned for r in QUERIES["t12_cleaned_words"](spark, SF).collect()}
    stems = {r.doc_id: r.cleaned for r in QUERIES["t12_full_cleaning"](spark, SF).collect()}
    assert stems == {d: None if t is None else " ".join(stem_word(w) for w in t.split()) for d, t in words.items()}
    assert stems != words


def test_stem_words_keeps_nulls_and_order(spark):
    rows = [(1, ["running", "cats", "running", None]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    got = {r.id: r.s for r in df.select("id", stem_words("w").alias("s")).collect()}
    assert got == {1: ["run", "cat", "run", None], 2: [], 3: None}


def test_one_shot_takes_its_example_from_another_item(spark):
    rows = [(3, "q3", "C"), (1, "q1", "A"), (2, "q2", "B")]
    df = spark.createDataFrame(rows, "k int, p string, a string")
    got = {r.k: r.o for r in prompts.one_shot(df, "k", "p", "a", "o").collect()}
    assert got == {1: "q2 Bq1", 2: "q1 Aq2", 3: "q1 Aq3"}
    assert prompts.one_shot(df.filter("k = 1"), "k", "p", "a", "o").first().o == "q1"
    assert prompts.one_shot(df.filter(F.lit(False)), "k", "p", "a", "o").count() == 0
