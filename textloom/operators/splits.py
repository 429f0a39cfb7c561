"""Deterministic splits, folds, samples and label codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import HASH_SPACE, hash_key
from textloom.operators.ordering import ROWS_PER_BLOCK, dense_index, dense_index_by, prefix_offset, previous_value, shuffled_rank

CHARS_PER_BLOCK = 16 << 20


def ratio_split(df: DataFrame, key: str, shares: Mapping[str, float], seed: int, out: str = "split") -> DataFrame:
    """Assign named splits by hashing `key`; equal keys always land together.

    Row-local: no shuffle, no counting.
    """
    place, names, upper = hash_key(F.col(key), seed), list(shares), 0.0
    label: Column | None = None
    for name in names[:-1]:
        upper += shares[name]
        hit = place < int(round(upper, 9) * HASH_SPACE)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return df.withColumn(out, F.lit(names[-1]) if label is None else label.otherwise(names[-1]))


def nested_split(df: DataFrame, key: str, first: float, second: float, seed: int) -> DataFrame:
    """Cut off a test share, then a validation share of the rest with a second hash."""
    test = hash_key(F.col(key), seed) >= int(first * HASH_SPACE)
    validation = hash_key(F.col(key), seed + 1) >= int(second * HASH_SPACE)
    return df.withColumn("split", F.when(test, "test").when(validation, "validation").otherwise("train"))


def positional_split(df: DataFrame, order: str, shares: Mapping[str, float]) -> DataFrame:
    """Cut the rows, in order, at floor(share * n)."""
    total = df.count()
    indexed = dense_index(df, order, "row_idx")
    names, upper = list(shares), 0.0
    label: Column | None = None
    for name in names[:-1]:
        upper += shares[name]
        hit = F.col("row_idx") < int(total * round(upper, 9))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return indexed.withColumn("split", F.lit(names[-1]) if label is None else label.otherwise(names[-1]))


def offset_split(
    df: DataFrame, order: str, text: str, share: float, sep_len: int = 1, block_chars: int = CHARS_PER_BLOCK
) -> DataFrame:
    """Cut the end-to-end text at floor(share * characters); a text across the cut is divided.

    The texts travel in the blocks of the running sum, so a block holds about `block_chars` characters.
    """
    length = F.length(text) + sep_len
    sums = df.agg(F.sum(length).alias("chars"), F.count("*").alias("rows")).first()
    total = sums.chars - sep_len
    rows_per_block = min(ROWS_PER_BLOCK, max(1, sums.rows * block_chars // max(1, sums.chars)))
    placed = prefix_offset(df, order, length, "start_char", rows_per_block)
    cut = int(total * share)
    inside = F.greatest(F.lit(0), F.least(F.length(text), cut - F.col("start_char"))).cast("int")
    parts = F.array(
        F.struct(F.lit("train").alias("split"), F.substring(text, F.lit(1), inside).alias("piece")),
        F.struct(F.lit("test").alias("split"), F.substring(text, inside + 1, F.length(text)).alias("piece")),
    )
    exploded = placed.select(order, F.explode(parts).alias("p"))
    return exploded.select(order, "p.split", "p.piece").filter("piece <> ''")


def group_folds(df: DataFrame, key: str, folds: int, seed: int) -> DataFrame:
    """Fold number from the key's hash: equal texts share a fold, without a shuffle."""
    return df.withColumn("fold", (hash_key(F.col(key), seed) % folds).cast("int"))


def balanced_group_folds(df: DataFrame, key: str, folds: int) -> DataFrame:
    """Groups ranked by size go to folds in snake order, so fold sizes stay close."""
    sizes = df.groupBy(key).agg(F.count("*").alias("group_rows"))
    ranked = dense_index_by(sizes, [F.desc("group_rows"), F.col(key)], "rank")
    lap, spot = F.floor(F.col("rank") / folds), F.col("rank") % folds
    fold = F.when(lap % 2 == 0, spot).otherwise(folds - 1 - spot).cast("int")
    return df.join(ranked.select(key, fold.alias("fold")), key)


def proportional_sample(df: DataFrame, group: str, key: str, shares: Mapping[str, float], seed: int) -> DataFrame:
    """floor(share * n) rows of each listed group, chosen by a seeded shuffle."""
    share = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col(group))
    listed = df.filter(F.col(group).isin(list(shares)))
    wanted = listed.groupBy(group).agg(F.count("*").alias("__n")).withColumn("__take", F.floor(F.col("__n") * share))
    ranked = shuffled_rank(listed, key, seed, "rank", group=[group])
    return ranked.join(F.broadcast(wanted.select(group, "__take")), group).filter("rank < __take").drop("__take")


def learning_subsets(df: DataFrame, key: str, sizes: Sequence[int], seed: int) -> DataFrame:
    """The first n rows of one shuffle for each n, as `(subset, ...)` rows."""
    order = [hash_key(F.col(key), seed), F.col(key)]
    largest = df.orderBy(*order).limit(max(sizes))
    ranked = shuffled_rank(largest, key, seed, "rank")
    subsets = F.array(*[F.lit(n) for n in sizes])
    member = F.filter(subsets, lambda n: F.col("rank") < n)
    return ranked.withColumn("subset", F.explode(member))


def exact_sample(df: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """Exactly `count` rows of a seeded shuffle (a distributed top-k)."""
    return df.orderBy(hash_key(F.col(key), seed), F.col(key)).limit(count)


def encode_sorted(df: DataFrame, label: str, out: str) -> DataFrame:
    """Class codes in alphabetical order."""
    classes = dense_index_by(df.select(label).distinct(), [F.col(label)], out)
    return df.join(classes, label)


def encode_first_seen(df: DataFrame, label: str, order: str, out: str) -> DataFrame:
    """Class codes in the order of first appearance along a unique numeric column."""
    first = df.groupBy(label).agg(F.min(order).alias("__first"))
    return df.join(dense_index(first, "__first", out).drop("__first"), label)


def leaking_groups(df: DataFrame, key: str) -> DataFrame:
    """Groups that occur in more than one fold."""
    spread = df.groupBy(key).agg(F.min("fold").alias("lo"), F.max("fold").alias("hi"), F.count("*").alias("n"))
    return spread.filter("lo <> hi")


def violations_in_order(df: DataFrame, group: str, order: str, value: str, block: Column | None = None) -> DataFrame:
    """Rows whose value does not exceed the value before it in the same group; `block` as in `ordering.runs`."""
    return previous_value(df, [group], order, value, "previous", block).filter(F.col(value) <= F.col("previous"))
