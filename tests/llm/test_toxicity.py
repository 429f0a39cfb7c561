"""Toxicity: held-out recall at few false alarms, the label model against plain sums, odd input."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from textloom.llm import toxicity
from textloom.llm.queries import QUERIES


def test_recall_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null").collect()}
    rows = [r for r in QUERIES["op2_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    toxic = [r.predicted for r in rows if labels[r.doc_id]]
    clean = [r.predicted for r in rows if not labels[r.doc_id]]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    edge = sorted(r.score for r in rows if not labels[r.doc_id])[int(0.95 * len(clean))]
    assert sum(r.score > edge for r in rows if labels[r.doc_id]) >= 0.85 * len(toxic)


def _plain_fit(masks, start, rounds):
    """The same model by loops over documents, kinds and voters."""
    model = start
    n = sum(masks.values())
    for _ in range(rounds):
        size = [0.0] * len(start.share)
        fired = [[0.0] * start.fires.shape[1] for _ in start.share]
        for mask, times in masks.items():
            each = []
            for share, fires in zip(model.share, model.fires):
                p = share
                for j, f in enumerate(fires):
                    p *= f if mask >> j & 1 else 1 - f
                each.append(p)
            for k, p in enumerate(each):
                size[k] += times * p / sum(each)
                for j in range(len(fired[k])):
                    fired[k][j] += times * p / sum(each) * (mask >> j & 1)
        share = np.array([(size[k] + n * start.share[k]) / (2 * n) for k in range(len(size))])
        fires = np.array([
            [(fired[k][j] + n * start.share[k] * start.fires[k][j]) / (size[k] + n * start.share[k]) for j in range(len(fired[k]))]
            for k in range(len(size))
        ])
        model = toxicity.LabelModel(start.toxic, share, fires)
    return model


def test_label_model_equals_plain_sums(spark):
    rng = random.Random(3)
    masks: dict[int, int] = {}
    for _ in range(200):
        rates = rng.choice([[0.02] * 5, [0.9, 0.8, 0.05, 0.05, 0.1], [0.05, 0.05, 0.8, 0.7, 0.1]])
        mask = sum(1 << j for j, rate in enumerate(rates) if rng.random() < rate)
        masks[mask] = masks.get(mask, 0) + 1
    start = toxicity.LabelModel(
        np.array([0.0, 1.0, 1.0]), np.array([0.8, 0.1, 0.1]),
        np.array([[0.05] * 5, [0.6, 0.6, 0.1, 0.1, 0.1], [0.1, 0.1, 0.6, 0.6, 0.1]]),
    )
    frame = spark.createDataFrame(list(masks.items()), "mask long, n long")
    got, want = toxicity.fit_label_model(frame, start, rounds=4), _plain_fit(masks, start, 4)
    votes = toxicity.bits(np.array(list(masks)), 5)
    assert np.allclose(got.share, want.share) and np.allclose(got.posterior(votes), want.posterior(votes))


def test_groups_of_correlated_voters():
    votes = np.array([[1, 1, 0, 0], [1, 1, 0, 0], [0, 0, 1, 0], [0, 0, 1, 1], [0, 0, 0, 0], [0, 0, 0, 0]], dtype=float)
    assert toxicity.correlated_groups(votes, np.ones(6)).tolist() == [0, 0, 2, 2]


def test_repeated_beginnings():
    counts = {"stemmed": 1, "stemming": 1, "other": 1}
    assert toxicity.repeated_beginnings(counts, 3) == {"stem", "stemm"}
    assert toxicity.repeated_beginnings(counts, 2_000) == set()  # two of 2,000 words are too few
    assert toxicity.repeated_beginnings({}, 0) == set()


def test_a_stem_that_no_list_holds_is_learned(spark):
    rng = random.Random(1)
    ends = [a + b for a in "aeiou" for b in "klmnr"]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(["river", "stone", "cloud", "grass", "light", "paper"]) + rng.choice(ends) for _ in range(40)]
        bad = i % 6 == 0
        for place in rng.sample(range(40), 4 if bad else 1 if i % 6 == 1 else 0):
            words[place] = "zorvak" + rng.choice(ends)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r.predicted, r.doc_id % 6 == 0) for r in got if r.held_out]
    assert sum(p for p, bad in held if bad) >= 0.9 * sum(bad for _, bad in held)
    assert sum(p for p, bad in held if not bad) <= 0.05 * len(held)


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows(spark, labelled):
    long = "word " * 400_000 + "idiot idiot"
    docs = spark.createDataFrame(
        [(None, "a b", 1), (1, None, 2), (1, None, 2), (2, "", 3), (3, long, 4), (4, "you idiot, you moron, you idiot", 5)],
        "doc_id long, text string, score int",
    ).selectExpr("*", "1 as mask", "2 as term", "3 as held_out")
    labels = spark.createDataFrame([(4, 1), (4, 0), (3, 0), (None, 1), (2, None)] if labelled else [], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2, 3, 4]
    assert all(0 <= r.score <= 1 and math.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
