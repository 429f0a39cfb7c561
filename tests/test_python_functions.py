"""Queries without SQL, against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.conftest import SF
from textloom.functions import fuzzy
from textloom.functions.encoding import repaired, to_ascii
from textloom.functions.stemming import stem_word

QUERIES = entry_module.queries()
short = hs.text(alphabet="abc ", max_size=12)


def plain_lcs(a, b):
    grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
    return grid[-1][-1]


def plain_window(a, b):
    a, b = sorted((a, b), key=len)
    if not a:
        return 0.0 if b else 100.0
    pieces = [b[max(0, s) : s + len(a)] for s in range(1 - len(a), len(b))]
    return max(200 * plain_lcs(a, p) / (len(a) + len(p)) for p in pieces)


@settings(max_examples=200, deadline=None)
@given(short, short)
def test_scores_against_brute_force(a, b):
    assert fuzzy.lcs_length(a, b) == plain_lcs(a, b)
    assert fuzzy.best_window(a, b) == pytest.approx(plain_window(a, b)) if len(a) != len(b) else True
    assert fuzzy.best_window(a, a) == 100.0
    for score in (fuzzy.indel_ratio, fuzzy.token_set, fuzzy.weighted, fuzzy.quick, fuzzy.winkler):
        assert 0 <= score(a, b) <= 100
        assert score(a, b) == pytest.approx(score(b, a))


def test_known_scores():
    assert fuzzy.indel_ratio("A Large Cap Stock", "A large Cap Stock") == pytest.approx(200 * 16 / 34)
    assert fuzzy.best_window("blue lamp is", "The blue lamp is bright today") == 100.0
    assert fuzzy.token_set("The blue lamp is", "The blue lamp is bright today") == 100.0
    assert fuzzy.winkler("MARTHA", "MARHTA") == pytest.approx(96.1111, abs=1e-3)


def test_stems():
    words = "caresses ponies cats agreed plastered motoring hopping falling happy relational rational adjustment probate controlling".split()
    want = "caress poni cat agre plaster motor hop fall happi relat ration adjust probat control".split()
    assert [stem_word(w) for w in words] == want


def test_stem_query_equals_stemming_every_word(spark, tables):
    from textloom.functions import text as tx

    rows = tables.documents.select("doc_id", tx.words(tx.strip_punctuation(F.lower("text"))).alias("w")).collect()
    got = {r.doc_id: r.stemmed for r in QUERIES["t9_stems"](spark, SF).collect()}
    assert all(got[r.doc_id] == " ".join(map(stem_word, r.w)) for r in rows)


def test_repair_undoes_a_wrong_code_page(spark, tables):
    damaged = ["cafÃ© \xe2\x80\x99n", "it’s 5 € – ok", "café", "", None]
    rows = spark.createDataFrame([(t,) for t in damaged], "t string").select(repaired(F.col("t")).alias("t")).collect()
    assert [r.t for r in rows] == ["café ’n", "it’s 5 € – ok", "café", "", None]
    assert to_ascii("Crème brûlée – ß") == "Creme brulee - ss"
    got = {r.doc_id: r.repaired for r in QUERIES["t14_repair_encoding"](spark, SF).collect()}
    assert all(got[r.doc_id] == to_ascii(r.text) for r in tables.documents.select("doc_id", "text").collect())


@pytest.mark.parametrize(
    "name, column, score",
    [
        ("t20_edit_ratio", "ratio", fuzzy.indel_ratio),
        ("t21_partial_ratio", "partial_ratio", fuzzy.best_window),
        ("t22_token_set_ratio", "token_set_ratio", fuzzy.token_set),
        ("t23_weighted_ratio", "w_ratio", fuzzy.weighted),
    ],
)
def test_score_queries(spark, tables, name, column, score):
    from textloom.operators.prompts import turn_pairs

    pairs = {(r.conv_id, r.pair_turn): r for r in turn_pairs(tables.conversations).collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        pair = pairs[r.conv_id, r.pair_turn]
        assert r[column] == pytest.approx(score(pair.question, pair.answer), abs=1e-3)


def test_rouge_l(spark, tables):
    import re

    scores = []
    for row in tables.documents.select("text").collect():
        ref = re.findall("[a-z0-9]+", row.text.lower())
        pred = [w for i, w in enumerate(ref) if (i + 1) % 5]
        scores.append(2 * len(pred) / (len(pred) + len(ref)) if ref else 0.0)  # a subsequence of the reference
    got = QUERIES["q6_rouge_l"](spark, SF).first().rouge_l
    assert got == pytest.approx(100 * np.mean(scores), abs=1e-3)


def test_principal_components(spark, tables):
    rows = tables.embeddings.orderBy("vec_id").toPandas()
    x = np.stack(rows.embedding.to_numpy()).astype(float)
    _, vectors = np.linalg.eigh(np.cov(x.T))
    want = x @ vectors[:, [-1, -2]]
    got = QUERIES["v6_principal_components"](spark, SF).orderBy("vec_id").toPandas()[["x", "y"]].to_numpy()
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-4)


def test_classifiers_beat_the_majority(spark, tables):
    """On a class that the vectors do decide; the table's own labels are random."""
    from textloom.operators import models

    known = tables.embeddings.withColumn("label", (F.col("embedding")[0] > F.col("embedding")[1]).cast("int"))
    base = models.majority_baseline(known, "label").first().accuracy
    trained = [
        models.logistic_regression(known, "embedding", "label"),
        models.perceptron_head(known, "embedding", "label", [64, 8, 2]),
    ]
    for model in trained:
        rows = models.predict(model, known, "embedding", "label", ["vec_id"]).toPandas()
        assert (rows.label == rows.prediction).mean() > base + 0.2
    for name in ("m3_logistic_regression", "m3_perceptron_head"):
        assert len(QUERIES[name](spark, SF).collect()) > 0


def test_sweep_topics_and_folds(spark, tables):
    clusters = QUERIES["v8_cluster_sweep"](spark, SF).toPandas()
    assert len(clusters) == tables.embeddings.count() and clusters.probability.between(0, 1).all()
    topics = QUERIES["m1_lda_topics"](spark, SF).toPandas()
    assert topics.topic.nunique() == 10 and (topics.groupby("topic").size() == 10).all()
    assert len(QUERIES["m5_cross_validation"](spark, SF).collect()) == 2
