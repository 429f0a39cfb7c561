"""Mixing sources to target weights, to the exact word.

Every document gets a hash-random key. Within each source the documents are
sorted by it, over range blocks of the key, so a source with a third of all
rows is spread over as many tasks as any other. Block totals and running sums
inside blocks give each document's offset in its source's shuffled order, and
the source is cut at its budget. A budget above the source's size takes whole
epochs first; the rest of it is cut from the same order.

Empty and null texts have size 0 and are taken 0 times. A null source is a
source of its own, the last. Repeated rows are documents like any other; which
of two identical rows is cut does not show. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Stored, word_count

BLOCK_BITS = 16


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float], most_epochs: int) -> dict:
    """Target of each source: shares of the total by weight, none above `most_epochs` times its size.

    Sources are ordered by code point, null last; the weights repeat in that
    order. What a capped source cannot take is shared again among the others.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(ordered)}
    limit = {name: float(most_epochs * size) for name, size in ordered}
    left, open_sources, target = float(sum(size for _, size in ordered)), [name for name, _ in ordered], {}
    while open_sources:
        total = sum(weight[name] for name in open_sources)
        over = [name for name in open_sources if left * weight[name] / total > limit[name]]
        if not over:
            target |= {name: left * weight[name] / total for name in open_sources}
            break
        for name in over:
            target[name] = limit[name]
        left -= sum(limit[name] for name in over)
        open_sources = [name for name in open_sources if name not in target]
    return target


def mix(
    docs: DataFrame, size: Column, weights: Sequence[float] = (1, 2, 3), most_epochs: int = 3, seed: int = 17
) -> DataFrame:
    """`docs` with `size`, `source_size`, `target` and `taken` (words taken, repeats counted).

    The sources' totals, one row for each source, pass through the driver.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("size", size).withColumn("__key", F.xxhash64(F.lit(seed), "doc_id", "size"))
    totals = [(r.source, r.n) for r in keyed.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    target = targets(totals, weights, most_epochs)
    plan = [(name, n, target[name], int(target[name])) for name, n in totals]
    # An Arrow table is read without Python workers, which would wait in every executor for further tasks.
    fields = pa.schema([("__source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64()), ("__budget", pa.int64())])
    budgets = spark.createDataFrame(pa.Table.from_pylist([dict(zip(fields.names, row)) for row in plan], fields))

    rows = keyed.withColumn("__block", F.shiftright("__key", 64 - BLOCK_BITS))
    earlier = Window.partitionBy("source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("source", "__block").agg(F.sum("size").alias("__n"))
    before = blocks.select(
        F.col("source").alias("__source"), F.col("__block").alias("__at"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
    )
    inside = (
        Window.partitionBy("source", "__block").orderBy("__key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__block") == F.col("__at")))
    placed = placed.drop("__source").join(budgets, F.col("source").eqNullSafe(F.col("__source")))

    epochs = F.when(F.col("source_size") > 0, F.expr("__budget div source_size")).otherwise(0)
    rest = F.col("__budget") - epochs * F.col("source_size") - F.col("__before") - F.col("__inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.withColumn("taken", taken.cast("long")).select(
        *docs.columns, "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix: each as often as whole epochs take it, and the cut one up to its last word taken.

    Keeps the columns of `docs`; `text` and `n_chars` of a cut document are of its first words.
    """
    sized = Stored(
        docs.select(F.monotonically_increasing_id().alias("__uid"), *docs.columns), "documents"
    ).df
    taken = mix(sized.select("__uid", "doc_id", "source", "text").withColumn("__words", word_count(F.col("text"))).drop("text"),
                F.col("__words"), **settings).select("__uid", F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    rows = sized.join(taken.filter("__taken > 0"), "__uid")
    whole = F.expr("__taken div __size")
    rest = F.col("__taken") - whole * F.col("__size")
    parts = F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>"))
    )
    repeated = rows.withColumn("__first", F.explode(parts))
    first_words = F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col("__first").cast("int"))
    cut = F.when(F.col("__first") > 0, F.array_join(first_words, " ")).otherwise(F.col("text"))
    columns = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = repeated.select(*columns, cut.alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
