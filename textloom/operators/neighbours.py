"""Nearest rows of every row by the cosine of their vectors.

`nearest_rows` cuts the vectors by random-projection trees: a node that holds
more than `leaf` vectors is split at the medians of three random directions,
round by round, until every leaf is a block that one task compares by one matrix
product, keeping the best k of each row. Several trees with other directions
meet pairs that one tree has parted; the lists of a row combine into its best k.
A tree looks at no more than `leaf` vectors for each vector, so the work grows
with the table and not with its square. A table of at most `leaf` vectors is one
block, and the result is exact.

Equal vectors are one node of the trees, with the smallest of their ids, so a
vector that a third of all rows share costs what any other does.

`nearest_exact` compares stated queries with all rows in blocks of both.

Vectors that are null, empty, zero or hold a null or non-finite value take no
part. Ids are unique and not null. Ties go to the smaller id; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.sources.scratch import durable

LEAF = 2_048
DIRECTIONS = 3  # a node that is too large is cut into 2^3
_FOUND = "node long, near array<struct<minus double, other long>>"


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite values, not all of them zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """`(node, vec, ids)` from `rows(id, vec)`: each different vector once, with the smallest k + 1 of its ids."""
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("__i", first).filter(F.col("__i") <= k + 1)  # limited in each map task before the shuffle
    ids = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return ids.select(F.element_at("ids", 1).alias("node"), "vec", "ids")


def unit_matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    data = np.array(vectors.tolist(), dtype=np.float64)
    data /= np.abs(data).max(axis=1, keepdims=True)  # no overflow in the squares
    return data / np.sqrt((data * data).sum(axis=1, keepdims=True))


def best_of(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, own: np.ndarray) -> list[list[tuple[float, int]]]:
    """For each query the k rows with the largest cosine as `(-cosine, id)`, ties to the smaller id, its own id left out."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    cosine = queries @ rows.T
    cosine[ids[None, :] == own[:, None]] = -np.inf
    most = min(k, len(ids))
    # The last digits of a product depend on its shape: what is near the k-th is compared again, pair by pair.
    least = np.partition(cosine, len(ids) - most, axis=1)[:, len(ids) - most] - 1e-12
    out = []
    for query, row, bound in zip(queries, cosine, least):
        near = np.flatnonzero((row >= bound) & (row > -np.inf))
        value = (rows[near] * query).sum(axis=1)
        chosen = np.lexsort((ids[near], -value))[:most]
        out.append([(-float(value[c]), int(ids[near[c]])) for c in chosen])
    return out


def _projections(trees: int, round_no: int, seed: int):
    """The values of each vector along the directions of this round, for every tree: `(node, tree, p)` rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            data = unit_matrix(frame["vec"])
            for tree in range(trees):
                rng = np.random.default_rng((seed, round_no, tree))
                values = data @ rng.normal(size=(data.shape[1], DIRECTIONS))
                yield pd.DataFrame({"node": frame["node"], "tree": tree, "p": list(values)})

    return run


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the table and is never broadcast: stored, it looks far smaller than it is in memory.

    The trees' rows of a node and of a cell are run-length coded in parquet; broadcast, a row takes about 110 bytes.
    """
    return df.hint("merge")


def tree_leaves(vectors: DataFrame, trees: int, leaf: int = LEAF, rounds: int = 40, seed: int = 5) -> DataFrame:
    """`(tree, cell, node)`: the leaf of each of `vectors(node, vec)` in every tree.

    Only nodes that are too large take part in a round. Their number, not their vectors, goes into the medians' table.
    What is still too large after the rounds is cut by a hash.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    open_rows = durable(vectors.select("node", every).withColumn("cell", F.lit(0).cast("long")))
    done: list[DataFrame] = []
    for round_no in range(rounds):
        sizes = open_rows.groupBy("tree", "cell").agg(F.count("*").alias("__n"))
        done.append(open_rows.join(sizes.filter(F.col("__n") <= leaf), ["tree", "cell"]).select("tree", "cell", "node"))
        large = durable(open_rows.join(sizes.filter(F.col("__n") > leaf), ["tree", "cell"]).select("tree", "cell", "node"))
        if large.isEmpty():
            break
        some = vectors.join(shuffled(large.select("node").distinct()), "node", "left_semi").select("node", "vec")
        values = some.mapInPandas(_projections(trees, round_no, seed), "node long, tree int, p array<double>")
        placed = durable(shuffled(large).join(values, ["node", "tree"]))
        medians = placed.groupBy("tree", "cell").agg(
            *[F.percentile_approx(F.col("p")[i], 0.5, 1000).alias(f"__m{i}") for i in range(DIRECTIONS)]
        )
        # Cells are numbered by a hash of their path, so that any number of rounds fits.
        turns = [(F.col("p")[i] > F.col(f"__m{i}")).cast("int") for i in range(DIRECTIONS)]
        cell = F.xxhash64("cell", F.lit(round_no), *turns)
        open_rows = durable(placed.join(medians, ["tree", "cell"]).select("tree", cell.alias("cell"), "node"))
    else:
        sizes = open_rows.groupBy("tree", "cell").agg(F.count("*").alias("__n"))
        part = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("__n") / leaf))
        cut = open_rows.join(sizes, ["tree", "cell"])
        done.append(cut.select("tree", F.xxhash64("cell", part).alias("cell"), "node"))
    leaves = done[0]
    for rows in done[1:]:
        leaves = leaves.unionByName(rows)
    return leaves


def nearest_rows(rows: DataFrame, k: int, trees: int = 12, leaf: int = LEAF, seed: int = 5) -> DataFrame:
    """`(id, rank, neighbour, cosine)` of the k nearest found for each of `rows(id, vec)`, the nearest first."""
    rows = durable(rows.filter(usable(F.col("vec"))).select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")))
    classes = durable(vector_classes(rows, k))
    leaves = tree_leaves(classes.select("node", "vec"), trees, leaf, seed=seed)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        data, ids = unit_matrix(frame["vec"]), frame["node"].to_numpy()
        near = best_of(data, data, ids, k, ids)
        return pd.DataFrame({"node": ids, "near": [[{"minus": m, "other": o} for m, o in row] for row in near]})

    blocks = leaves.join(shuffled(classes.select("node", "vec")), "node")
    found = blocks.groupBy("tree", "cell").applyInPandas(compare, _FOUND)
    return _expanded(rows, classes, combined(found, k), k)


def combined(found: DataFrame, k: int) -> DataFrame:
    """The best k of the lists of each node: at most k entries come from each tree or block."""
    lists = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    return found.groupBy("node").agg(F.slice(lists, 1, k).alias("near"))


def _expanded(rows: DataFrame, classes: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """From vectors to rows: every row gets the rows with its own vector, then those of the nearest vectors."""
    others = near.select("node", F.explode("near").alias("e")).select("node", "e.minus", F.col("e.other").alias("other"))
    others = others.join(shuffled(classes.select(F.col("node").alias("other"), F.col("ids").alias("of_other"))), "other")
    entry = lambda minus: lambda i: F.struct(minus.alias("minus"), i.alias("id"))
    listed = others.select("node", F.transform("of_other", entry(F.col("minus"))).alias("l")).groupBy("node").agg(F.flatten(F.collect_list("l")).alias("far"))
    own = F.transform("ids", entry(F.lit(-1.0)))
    every = classes.join(shuffled(listed), "node", "left").select("vec", F.concat(own, F.coalesce("far", F.slice(own, 1, 0))).alias("entries"))
    kept = F.slice(F.array_sort(F.filter("entries", lambda e: e["id"] != F.col("id"))), 1, k)
    ranked = rows.join(shuffled(every), "vec").select("id", F.posexplode(kept).alias("at", "e"))
    return ranked.select("id", (F.col("at") + 1).alias("rank"), F.col("e.id").alias("neighbour"), (-F.col("e.minus")).alias("cosine"))


def nearest_exact(queries: DataFrame, rows: DataFrame, k: int, query_block: int = 1_024, row_block: int = 8_192) -> DataFrame:
    """The same for stated `queries(id, vec)` against all `rows(id, vec)`: every block of queries meets every block of rows."""
    shape = [F.col("id").cast("long").alias("node"), F.col("vec").cast("array<double>").alias("vec")]
    queries = durable(queries.filter(usable(F.col("vec"))).select(*shape))
    rows = durable(rows.filter(usable(F.col("vec"))).select(*shape))
    n_q, n_r = (max(1, math.ceil(df.count() / size)) for df, size in ((queries, query_block), (rows, row_block)))
    part = lambda n: F.pmod(F.xxhash64("node"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("node", "vec", part(n_q).alias("q")).select("*", every(n_r).alias("r"))
    right = rows.select("node", "vec", part(n_r).alias("r2")).select("*", every(n_q).alias("q2"))

    def compare(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or block.empty:
            return pd.DataFrame({"node": pd.Series(dtype="int64"), "near": pd.Series(dtype=object)})
        ids = asked["node"].to_numpy()
        near = best_of(unit_matrix(asked["vec"]), unit_matrix(block["vec"]), block["node"].to_numpy(), k, ids)
        return pd.DataFrame({"node": ids, "near": [[{"minus": m, "other": o} for m, o in row] for row in near]})

    found = left.groupBy("q", "r").cogroup(right.groupBy("q2", "r2")).applyInPandas(compare, _FOUND)
    ranked = combined(found, k).select("node", F.posexplode("near").alias("at", "e"))
    return ranked.select(F.col("node").alias("id"), (F.col("at") + 1).alias("rank"), F.col("e.other").alias("neighbour"), (-F.col("e.minus")).alias("cosine"))
