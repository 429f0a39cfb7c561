"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of the pivots by distance. It is posted in
the inverted files of its `post` nearest pivots; a query reads the files of its
`probe` nearest. Every vector of a file read is ranked by the Euclidean distance
in double precision: in a dense group the orders of pivots hardly differ, so a
cut by them would drop near vectors. A pair met in several files is looked at in
the first of them only. Files are cut into blocks by a hash of the id, queries
too, so a pivot with a third of all vectors is many bounded groups.

The pivots are a bounded sample, `pivots` vectors with the smallest hashes of
their ids; every vector is indexed. A query that finds fewer than `k` in its
files, though there are more candidates, is run again over all files, which is
exact.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id or of another length than most pivots. Repeated
rows are candidates of their own. Ties go to the smaller id. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.llm.common import Stored, map_batches, values

INDEXED = "pivot int, id long, places binary, vec binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Whether every component is finite and one is not zero."""
    infinity = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def choose_pivots(vectors: DataFrame, pivots: int) -> np.ndarray:
    """At most `pivots` different vectors of the commonest length among twice as many sampled."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(2 * pivots).select("vec").collect()
    if not sample:
        return np.empty((0, 0))
    length = Counter(len(r.vec) for r in sample).most_common(1)[0][0]
    different = dict.fromkeys(tuple(r.vec) for r in sample if len(r.vec) == length)
    return np.array(list(different)[:pivots], dtype=np.float64)


def _index(batches, pivots, files):
    for batch in batches:
        ids, vectors = values(batch, "id"), values(batch, "vec")
        right = [i for i, v in enumerate(vectors) if len(v) == pivots.shape[1]]
        out = {"pivot": [], "id": [], "places": [], "vec": []}
        for i in right:
            vector = np.array(vectors[i], dtype=np.float64)
            order = np.argsort(((pivots - vector) ** 2).sum(axis=1), kind="stable")
            places = np.empty(len(pivots), dtype=np.uint8)
            places[order] = np.arange(len(pivots))
            for pivot in order[:files].tolist():
                for name, value in zip(out, (pivot, ids[i], places.tobytes(), vector.tobytes())):
                    out[name].append(value)
        yield out


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = 64, post: int = 2, probe: int = 32,
    block: int = 4096,
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each `queries(id, vec)` its `k` nearest of `vectors(id, vec)` but itself."""
    if pivots > 255:
        raise ValueError("places of pivots are kept in bytes")
    vectors, queries = (
        df.select(F.col("id").cast("long").alias("id"), "vec").filter(F.col("id").isNotNull() & usable("vec"))
        for df in (vectors, queries)
    )
    chosen = choose_pivots(vectors, pivots)
    if not len(chosen):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = Stored(map_batches(vectors, _index, INDEXED, pivots=chosen, files=min(post, len(chosen))), "index")
    sizes = {r.pivot: r.n for r in indexed.df.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # one row a pivot
    found = Stored(_search(indexed, queries, chosen, sizes, k, post, probe, block), "found")
    best = _best(found.df, k)
    n = sum(sizes.values()) // min(post, len(chosen))
    counts = best.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min(k, n - 1))
    short = queries.join(counts, queries.id == counts.query_id, "left_anti")
    if n > 1 and not short.isEmpty():
        again = _search(indexed, short, chosen, sizes, k, post, len(chosen), block)
        whole = found.df.join(counts.select("query_id"), "query_id", "left_semi")
        best = _best(whole.unionByName(again), k)
    return best


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(indexed, queries, chosen, sizes, k, post, probe, block):
    probes = map_batches(queries, _index, INDEXED, pivots=chosen, files=min(probe, len(chosen)))
    asked = {r.pivot: r.n for r in probes.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # one row a pivot

    def blocks(counts: dict) -> Column:
        cut = [max(1, math.ceil(counts.get(p, 0) / block)) for p in range(len(chosen))]
        return F.get(F.array(*map(F.lit, cut)), F.col("pivot"))

    def dealt(df: DataFrame, own: str, own_blocks: Column, other: str, other_blocks: Column) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), own_blocks).cast("int")
        return df.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), other_blocks - 1)))

    listed = dealt(indexed.df, "list_block", blocks(sizes), "query_block", blocks(asked))
    asking = dealt(probes, "query_block", blocks(asked), "list_block", blocks(sizes))
    keys = ["pivot", "list_block", "query_block"]
    return (
        listed.groupBy(*keys).cogroup(asking.groupBy(*keys))
        .applyInPandas(_ranker(k, post, probe), FOUND)
    )


def _ranker(k: int, post: int, probe: int):
    def rank(listed: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(listed) and len(asking):
            listed = listed.sort_values("id", kind="stable")
            ids, query_ids = listed["id"].to_numpy(), asking["id"].to_numpy()
            places, own = (np.frombuffer(b"".join(df["places"]), np.uint8).reshape(len(df), -1) for df in (listed, asking))
            vectors, queries = (np.frombuffer(b"".join(df["vec"]), np.float64).reshape(len(df), -1) for df in (listed, asking))
            pivot = int(listed["pivot"].iloc[0])
            earlier = (places[:, :pivot] < post).astype(np.float32).T
            with np.errstate(over="ignore", invalid="ignore"):
                squares = (vectors * vectors).sum(axis=1)
                for at in range(0, len(queries), 256):
                    part = slice(at, at + 256)
                    asked = (queries[part] * queries[part]).sum(axis=1)
                    rough = squares + asked[:, None] - 2 * (queries[part] @ vectors.T)
                    away = ((own[part, :pivot] < probe).astype(np.float32) @ earlier > 0) | (query_ids[part, None] == ids)
                    slack = 1e-10 * (squares.max() + asked)  # far above the rounding of `rough`
                    for row, (near, out, most) in enumerate(zip(rough, away, slack), at):
                        here = np.flatnonzero(~out)
                        if len(here) > k and np.isfinite(most):
                            near = near[here]
                            here = here[near <= np.partition(near, k - 1)[k - 1] + most]
                        apart = vectors[here] - queries[row]
                        score = np.sqrt((apart * apart).sum(axis=1))
                        for i in np.lexsort((ids[here], score))[:k]:
                            found.append((query_ids[row], ids[here[i]], score[i]))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return rank
