"""Strings within an edit distance against all pairs."""

import random

import pytest

from textloom.operators import fuzzyjoin


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _names():
    rng = random.Random(3)
    names = {"", "a", "é", "ab", "abc", "abcd", "aaaaaaa", "aaaa", "bbbbbbbb", "  ", "中文", "aXbXcXd" * 3}
    for _ in range(60):
        name = "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 16)))
        names.add(name)
        for _ in range(3):
            letters = list(name)
            for _ in range(rng.randrange(1, 5)):
                at = rng.randrange(len(letters) + 1)
                letters[at : at + rng.randrange(2)] = rng.choice(["", "x", "b"])
            names.add("".join(letters))
    return sorted(names)


@pytest.mark.parametrize("distance", [1, 3])
def test_pairs_equal_all_pairs(spark, distance):
    names = _names()
    table = spark.createDataFrame(list(enumerate(names)), "id long, value string")
    got = {(r.a, r.b): (r.a_value, r.b_value, r.distance) for r in fuzzyjoin.fuzzy_pairs(table, distance).collect()}
    want = {}
    for j, b in enumerate(names):
        for i, a in enumerate(names[:j]):
            if abs(len(a) - len(b)) <= distance and (d := _distance(a, b)) <= distance:
                want[i, j] = (a, b, d)
    assert got == want and len(want) > 20


def test_links_count_rows_and_null_names_have_none(spark):
    rows = [(1, "blue ring"), (2, "blue rings"), (3, "blue ring"), (4, None), (5, "something else"), (6, None), (7, "blue ring")]
    table = spark.createDataFrame(rows, "key long, name string")
    got = {r.key: (r.class_id, r.links) for r in fuzzyjoin.fuzzy_links(table, "key", "name", 2).collect()}
    assert got == {1: (1, 3), 2: (2, 3), 3: (1, 3), 4: (None, 0), 5: (5, 0), 6: (None, 0), 7: (1, 3)}
    assert fuzzyjoin.fuzzy_links(table.filter("key < 0"), "key", "name", 2).count() == 0
