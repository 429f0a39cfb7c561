"""N-grams counted in Arrow batches against plain counters; no row for each n-gram where keys are unique."""

import random
from collections import Counter

from pyspark.sql import functions as F

from textloom.functions.arrays import cuts
from textloom.operators import metrics as mt


def _plain(rows, orders):
    sides = {}
    for key, p, r in rows:
        for words, side in ((p, 0), (r, 1)):
            for n in orders:
                grams = sides.setdefault((key, n), (Counter(), Counter()))[side]
                grams.update(tuple(words[i : i + n]) for i in range(len(words or ()) - n + 1))
    found = {k: (sum((p & r).values()), p.total(), r.total()) for k, (p, r) in sides.items()}
    return {k: v for k, v in found.items() if v[1] + v[2]}


def _rows(keys):
    rng = random.Random(4)
    some = lambda: rng.choices("abcdé", k=rng.choice([0, 1, 2, 3, 9, 40]))
    return [(k, some() if k != 7 else None, some()) for k in keys]


def _overlap(spark, rows, orders):
    df = spark.createDataFrame(rows, "id long, p array<string>, r array<string>")
    return mt.ngram_overlap(df, "id", F.col("p"), F.col("r"), orders)


def test_unique_keys_are_counted_in_place(spark):
    rows = _rows([*range(60), None])
    found = _overlap(spark, rows, [1, 2, 4])
    assert {(r.id, r.n): (r.common, r.n_pred, r.n_ref) for r in found.collect()} == _plain(rows, [1, 2, 4])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_rows_of_a_repeated_key_are_one_text(spark):
    rows = _rows([*range(30), None, None, 3, 3, 9])
    found = _overlap(spark, rows, [1, 2])
    assert {(r.id, r.n): (r.common, r.n_pred, r.n_ref) for r in found.collect()} == _plain(rows, [1, 2])


def test_cuts():
    import numpy as np

    assert list(cuts(np.array([3, 3, 9, 1, 0, 2]), 6)) == [(0, 2), (2, 3), (3, 6)]
    assert list(cuts(np.array([], dtype=int), 6)) == []
