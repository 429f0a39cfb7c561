"""The rule ensemble: its statistics, its rules as column expressions, and rows it did not learn from."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from textloom.llm import quality_model as model
from textloom.llm.queries import QUERIES

ODD = [
    (None, "a null id"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "other text, same id"),
    (5, "word " * 400_000), (6, "x" * 2_000_000), (7, "Menu | Home | About | Contact\n" * 30), (8, "中文 🙂.\n\n!!"),
]


def test_statistics_by_hand():
    got = dict(zip(model.STATISTICS, model.statistics("Go go go | NOW!! 12\n\nThe end.\nThe end.")))
    words = ["Go", "go", "go", "|", "NOW!!", "12", "The", "end.", "The", "end."]
    chars = sum(map(len, words))
    assert got["n_words"] == math.log1p(10) and got["word_length"] == chars / 10 and got["distinct_share"] == 0.7
    assert got["top_share"] == 0.2 and got["again_share"] == 0.1 and got["triple_share"] == 0.0
    assert got["capital_share"] == 0.1 and got["navigation_share"] == 0.1 and got["exclaim_share"] == 0.2
    assert got["digit_share"] == 2 / chars and got["n_lines"] == math.log1p(3) and got["line_repeat_share"] == pytest.approx(1 / 3)
    assert got["short_line_share"] == pytest.approx(2 / 3) and got["ended_share"] == pytest.approx(2 / 3)
    assert len(got) == len(model.statistics("")) and not any(model.statistics(" \n"))


def test_rules_narrow_and_compile(spark):
    rule = model.Rule(()).narrowed("top_share", -math.inf, 0.5).narrowed("n_words", 2.0, math.inf).narrowed("top_share", 0.1, math.inf)
    assert rule.bounds == (("n_words", 2.0, math.inf), ("top_share", 0.1, 0.5))
    assert rule.narrowed("top_share", 0.2, 0.9).bounds[1] == ("top_share", 0.2, 0.5)
    rows = [(n / 2, t / 10) for n in range(8) for t in range(8)]
    met = spark.createDataFrame(rows, "n_words double, top_share double").withColumn("met", rule.column())
    assert all(r.met == (2 < r.n_words and 0.1 < r.top_share <= 0.5) for r in met.collect())


def _by_rows(fitted, text):
    value = dict(zip(model.STATISTICS, model.statistics(text or "")))
    logit = fitted.bias + sum(w for rule, w in fitted.weights if all(a < value[s] <= b for s, a, b in rule.bounds))
    return 1 / (1 + math.exp(-logit))


@pytest.fixture(scope="module")
def small(spark):
    folder = "/root/testdata/sf0.01"
    return folder, spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_every_score_is_that_of_the_rules(spark, small):
    _, docs, labels = small
    fitted = model.fit(model.labelled(docs, labels, 16_000).df)
    assert 0 < len(fitted.weights) < 24 * 14  # the lasso leaves rules out
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    clash = docs.withColumn("good", F.lit("clash")).withColumn("n_words", F.lit(-1)).withColumn("score", F.lit(9))
    for r in model.quality_scores(clash, labels).collect():
        assert r.score == pytest.approx(_by_rows(fitted, texts[r.doc_id])) and r.predicted == (r.score >= 0.7)


def test_rows_held_out_are_told_apart(spark, small):
    folder, docs, labels = small
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = QUERIES["op11_quality_rules"](spark, folder).collect()
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    out = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    good, bad = [p for p, q in out if q], [p for p, q in out if not q]
    assert sum(good) >= 0.95 * len(good) and len(bad) >= 10 and sum(bad) <= 0.1 * len(bad)


def test_held_out_labels_are_not_read(spark, small):
    _, docs, labels = small
    turned = labels.withColumn("quality", F.when(model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = lambda known: sorted(map(tuple, model.labelled(docs, known, 16_000).df.collect()))
    assert rows(turned) == rows(labels)


def test_odd_rows_and_missing_labels(spark, small):
    _, docs, labels = small
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    none, all_good = labels.filter("doc_id < 0"), labels.withColumn("quality", F.lit(1))
    nulls = spark.createDataFrame([(None, 1, 0), (4, None, 0), (4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    for known in (none, all_good, nulls, labels):
        got = model.quality_scores(odd, known).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.held_out in (True, False) for r in got)
    assert {r.score for r in model.quality_scores(odd, none).collect()} == {0.5}
    assert model.quality_scores(odd.filter("doc_id < 0"), labels).count() == 0
    both = docs.select("doc_id", "text").unionByName(odd)
    scores = [r.score for r in model.quality_scores(both, labels).filter("doc_id in (1, 2, 3)").collect()]
    assert len(scores) > 3 and min(scores) >= 0
