"""Nearest rows of every row against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import neighbours


def _table(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")


def _all_pairs(vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, -np.inf)
    return {(i, int(j)) for i, row in enumerate(cosine) for j in np.argsort(-row, kind="stable")[:k]}


def _sample(kind, n, rng):
    if kind == "random":
        return rng.normal(size=(n, 16))
    groups = 20 if kind == "clusters" else 1
    centres = rng.normal(size=(groups, 64))
    vectors = centres[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, 64))
    if kind == "hot third":
        cold = rng.random(n) >= 0.34
        vectors[cold] = np.repeat(rng.normal(size=(cold.sum() // 10 + 1, 64)), 10, axis=0)[: cold.sum()] + 0.3 * rng.normal(size=(cold.sum(), 64))
    return vectors


@pytest.mark.parametrize("kind", ["random", "clusters", "hot third"])
def test_recall_and_pairs_looked_at(spark, kind):
    vectors, leaf, trees = _sample(kind, 6_000, np.random.default_rng(4)), 500, 20
    table = _table(spark, vectors).repartition(8)
    got = neighbours.nearest_rows(table, 5, trees=trees, leaf=leaf).collect()
    want = _all_pairs(vectors, 5)
    assert len(got) == len(want) and len({(r.id, r.rank) for r in got}) == len(want)
    recall = len({(r.id, r.neighbour) for r in got} & want) / len(want)
    print(kind, "recall", recall)
    assert recall >= 0.95


def test_leaves_are_bounded_and_whole_so_that_work_grows_with_the_table(spark):
    rng, looked_at = np.random.default_rng(5), {}
    for n in (2_000, 8_000):
        classes = _table(spark, rng.normal(size=(n, 8))).withColumnRenamed("id", "node")
        leaves = neighbours.tree_leaves(classes, trees=3, leaf=200)
        sizes = leaves.groupBy("tree", "cell").agg(F.count("*").alias("n")).collect()
        assert max(r.n for r in sizes) <= 200
        assert all(sum(r.n for r in sizes if r.tree == tree) == n for tree in range(3))
        looked_at[n] = sum(r.n**2 for r in sizes)
    assert looked_at[8_000] < 8 * looked_at[2_000] and looked_at[8_000] < 0.1 * 3 * 8_000**2


def test_a_vector_shared_by_a_third_of_all_rows(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(900, 6))
    vectors[::3] = vectors[0]
    got = {}
    for r in neighbours.nearest_rows(_table(spark, vectors), 4, trees=6, leaf=100).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour, r.cosine))
    assert len(got) == 900 and all(len(rows) == 4 for rows in got.values())
    assert [n for _, n, _ in sorted(got[0])] == [3, 6, 9, 12] and [n for _, n, _ in sorted(got[3])] == [0, 6, 9, 12]
    assert all(c == 1 for _, _, c in got[600])


def test_one_leaf_and_blocks_are_exact_on_odd_vectors(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0]]
    good = [[1.0, 0.0], [2.0, 0.0], [0.0, 3.0], [1.0, 1.0], [-1.0, 0.0], [1.0, 1.0], [1e200, 1e200]]
    table = spark.createDataFrame(list(enumerate(good + bad)), "id long, vec array<double>").withColumn("node", F.lit("clash"))
    want = {0: [1, 3, 5], 1: [0, 3, 5], 2: [3, 5, 6], 3: [5, 6, 0], 4: [2, 3, 5], 5: [3, 6, 0], 6: [3, 5, 0]}
    for got in (neighbours.nearest_rows(table, 3), neighbours.nearest_exact(table, table, 3, query_block=2, row_block=3)):
        lists = {}
        for r in sorted(got.collect(), key=lambda r: r.rank):
            lists.setdefault(r.id, []).append((r.neighbour, round(r.cosine, 9)))
        assert {i: {n for n, _ in row} for i, row in lists.items()} == {i: set(row) for i, row in want.items()}
        assert all([c for _, c in row] == sorted((c for _, c in row), reverse=True) for row in lists.values())
    empty = table.filter("id < 0")
    assert neighbours.nearest_rows(empty, 3).count() == 0 and neighbours.nearest_exact(empty, table, 3).count() == 0


def test_no_side_that_grows_with_the_table_is_broadcast(spark, monkeypatch):
    plans, real = [], neighbours.durable
    monkeypatch.setattr(neighbours, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    found = neighbours.nearest_rows(_table(spark, np.random.default_rng(7).normal(size=(900, 4))), 3, trees=3, leaf=100)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    joins = [line for plan in plans for line in plan.split("\n") if "Join [" in line]
    assert any("node#" in line for line in joins)
    # Tables of cells alone are small: a cell stands for many vectors.
    assert not [line for line in joins if "Broadcast" in line and not ("tree#" in line and "cell#" in line)]
