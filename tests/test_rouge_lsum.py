"""ROUGE-Lsum against a plain table of common subsequences."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import fuzzy
from textloom.operators import metrics
from textloom.plans import load_all
from textloom.plans.registry import QUERIES


def _plain_places(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    i, j, found = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            found.insert(0, i - 1)
            i, j = i - 1, j - 1
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def _plain_hits(reference, predicted):
    held = [w for s in predicted for w in s]
    hits = 0
    for sentence in reference:
        for place in sorted({p for other in predicted for p in _plain_places(sentence, other)}):
            if sentence[place] in held:
                held.remove(sentence[place])
                hits += 1
    return hits


def test_places_and_hits_equal_the_plain_table():
    rng = random.Random(2)
    line = lambda: [rng.choice("abcdef") for _ in range(rng.randrange(12))]
    for _ in range(400):
        a, b = line(), line()
        assert fuzzy.lcs_places(a, b) == _plain_places(a, b)
        reference, predicted = [line() for _ in range(rng.randrange(4))], [line() for _ in range(rng.randrange(4))]
        assert fuzzy.union_hits(reference, predicted) == _plain_hits(reference, predicted)


def test_lines_are_not_compared_once_their_words_are_covered(monkeypatch):
    # Every line shares words with all others; each prediction leaves out every fifth word of its line, or swaps two words.
    calls, plain = [], fuzzy.lcs_places
    monkeypatch.setattr(fuzzy, "lcs_places", lambda *sides: calls.append(1) or plain(*sides))
    rng = random.Random(3)
    lines = [["the", *(rng.choice("abcdefgh") for _ in range(10)), "of"] for _ in range(40)]
    shorter = [[w for i, w in enumerate(s, 1) if i % 5] for s in lines]
    assert fuzzy.union_hits(lines, shorter) == _plain_hits(lines, shorter) and len(calls) <= len(lines)
    swapped = [[s[1], s[0], *s[2:]] for s in shorter]
    assert fuzzy.union_hits(lines, swapped) == _plain_hits(lines, swapped)


def test_places_of_a_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randrange(12))]
        b, other = [w for w in a if rng.random() < 0.6], [rng.choice("abc") for _ in range(rng.randrange(6))]
        assert fuzzy.embedded_places(a, b) == _plain_places(a, b)
        assert fuzzy.embedded_places(a, other) in (None, _plain_places(a, other))


def test_a_known_example():
    # The places of both predicted lines are united: w1 w2 and w1 w3 w5 make four of five words.
    assert fuzzy.union_hits([["w1", "w2", "w3", "w4", "w5"]], [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]) == 4


def test_odd_rows(spark):
    rows = [(1, None, None), (2, [], [["a"]]), (3, [["a"]], []), (4, [[], ["a", "b"]], [["a", "b"]]), (5, [["a"]], None)]
    df = spark.createDataFrame(rows, "id int, p array<array<string>>, r array<array<string>>")
    got = dict(df.select("id", metrics.rouge_lsum(F.col("p"), F.col("r"))).collect())
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 1.0, 5: 0.0}


def test_query_equals_a_plain_version(spark, tables):
    import re

    total, n = 0.0, 0
    for row in tables.documents.select("text").collect():
        reference = [re.findall("[a-z0-9]+", line) for line in (row.text or "").lower().split("\n")]
        predicted = [[w for i, w in enumerate(s, 1) if i % 5] for s in reference]
        sizes = sum(map(len, reference)) + sum(map(len, predicted))
        total += 2 * fuzzy.union_hits(reference, predicted) / sizes if sizes else 0.0
        n += 1
    load_all()
    got = QUERIES["q6_rouge_lsum"](spark, tables.folder).collect()[0].rouge_lsum
    assert got == pytest.approx(100 * total / n, abs=1e-3)
