"""Texts just under the similarity: no row for each pair of a group, and no edge between different texts lost."""

import numpy as np

from tests.llm import brute
from textloom.llm import simhash


def _sets(n=120, size=40):
    """Sets of a common part and own shingles: some pairs at 0.8 or more, most below."""
    rng = np.random.default_rng(5)
    sets = [np.unique(np.concatenate([np.arange(30), rng.integers(100, 130, size - 30)])) for _ in range(n)]
    return sets + [np.append(s[:-1], 1000 + k) for k, s in enumerate(sets[:10])]


def _alike(a, b):
    both = len(np.intersect1d(a, b))
    return both >= 0.8 * (len(a) + len(b) - both)


def test_forest_of_sets_connects_what_all_pairs_connect():
    sets = _sets()
    packed = np.zeros((len(sets), 8), dtype=np.uint8)
    roots = np.arange(len(sets))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if _alike(sets[i], sets[j])]
    edges = list(simhash.alike_forest(packed, roots, roots, sets, 64, 0.8))
    assert brute.components(edges) == brute.components(pairs)
    assert len(edges) < len(sets) and len(pairs) > len(sets)
    halves = np.arange(len(sets)) % 2
    across = [(i, j) for i, j in pairs if halves[i] != halves[j]]
    assert brute.components(list(simhash.alike_forest(packed, roots, halves, sets, 64, 0.8))) == brute.components(across)


def test_rows_of_a_group_of_near_misses_do_not_grow_with_its_square(spark, monkeypatch):
    """80 texts with 40 words in common and 9 of their own: pairs meet and fail, but for two copies with one word changed."""
    common = [f"common{i}" for i in range(40)]
    texts = [" ".join([*common, *(f"own{k}x{i}" for i in range(9))]) for k in range(80)]
    texts += [texts[3] + " more", texts[70] + " more"]
    made = []
    whole = simhash.Stored

    def stored(df, name):
        found = whole(df, name)
        made.append((name, found.df.count()))
        return found

    monkeypatch.setattr(simhash, "Stored", stored)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()} == set(range(80))
    assert "sets" in dict(made) and max(n for _, n in made) < 80 * 79 / 4


def test_blocks_of_a_group_meet(spark):
    """Small blocks: edges between blocks are found as well."""
    sets = _sets()
    texts = [" ".join(f"w{v}" for v in s) for s in sets]  # one word a shingle
    rows = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")
    prints = [simhash.fingerprint(np.unique(simhash.shingle_hashes(t.encode(), 1)), 1) for t in texts]
    rooted = spark.createDataFrame([(k, p, k) for k, p in enumerate(prints)], "node long, fp binary, root long")
    groups = spark.createDataFrame([(k, 0) for k in range(len(sets))], "node long, root long")
    found = simhash._alike_in_groups(rows, rooted, groups, 1, 0.8, 8, 64, block=20).collect()
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if _alike(sets[i], sets[j])]
    assert brute.components([(r.a, r.b) for r in found]) == brute.components(pairs)
