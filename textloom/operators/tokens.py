"""Vocabulary, encoding, packing and calibration windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.hashing import WIDE_BITS, hash_key
from textloom.operators.ordering import by_key, dense_index, prefix_offset
from textloom.operators.statistics import top_words
from textloom.sources.scratch import durable

BROADCAST_WORDS = 200_000
EOS = 0


def fit_vocabulary(df: DataFrame, words: Column, cap: int) -> DataFrame:
    """The `cap` most frequent words with ids from 1, ties by word.

    Only the capped list is numbered in one place.
    """
    top = top_words(df, words, cap)
    return top.withColumn("id", F.row_number().over(Window.orderBy(F.desc("n"), "word"))).select("word", "id", "n")


def encode(
    df: DataFrame, key: str | Sequence[str], words: Column, vocabulary: DataFrame, cap: int, parts: int | None = None
) -> DataFrame:
    """`(key, ids, word_ids)` per text, where `key` is one column or several; unknown words are dropped.

    The texts are partitioned by key first, so looking the words up in the
    broadcast vocabulary and gathering them again needs no further shuffle.
    A vocabulary above the broadcast bound is joined by shuffle instead. `parts`
    is as in `ordering.by_key`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = by_key(df, keys, parts).select(*keys, F.posexplode_outer(words).alias("pos", "word"))
    table = vocabulary.select("word", F.col("id").alias("__code"))
    coded = rows.join(F.broadcast(table) if cap <= BROADCAST_WORDS else table, "word", "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("__code").isNotNull(), F.struct("pos", "__code"))))
    gathered = coded.groupBy(*keys).agg(kept.alias("t"))
    return gathered.select(
        *keys,
        F.transform("t", lambda s: s["__code"]).alias("ids"),
        F.transform("t", lambda s: s["pos"]).alias("word_ids"),
    )


def decode(df: DataFrame, key: str, ids: Column, vocabulary: DataFrame, parts: int | None = None) -> DataFrame:
    """Ids back to a blank-joined text; `parts` as in `ordering.by_key`."""
    rows = by_key(df, [key], parts).select(key, F.posexplode_outer(ids).alias("pos", "id"))
    named = rows.join(vocabulary.select("id", "word"), "id", "left")
    words = F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("pos", "word"))))
    return named.groupBy(key).agg(F.array_join(F.transform(words, lambda s: s["word"]), " ").alias("text"))


def block_pieces(df: DataFrame, key: str, ids: str, length: int, eos: int = EOS) -> DataFrame:
    """Cut each text's ids at the block borders of the end-to-end token stream.

    Each text is followed by `eos`.  Output: `(block, at, piece)`; whole array
    slices travel, not single tokens.  `df` should be a stored table: it is
    read twice.
    """
    ended = df.select(key, F.concat(F.col(ids), F.array(F.lit(eos))).alias("__ids"))
    placed = prefix_offset(ended.select(key, F.size("__ids").alias("__n")), key, F.col("__n"), "__from")
    rows = ended.join(placed, key)
    first = F.floor(F.col("__from") / length)
    last = F.floor((F.col("__from") + F.col("__n") - 1) / length)
    cut = rows.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("__from"), F.col("block") * length)
    end = F.least(F.col("__from") + F.col("__n"), (F.col("block") + 1) * length)
    piece = F.slice("__ids", (begin - F.col("__from") + 1).cast("int"), (end - begin).cast("int"))
    return cut.select("block", begin.alias("at"), piece.alias("piece"))


def pack(df: DataFrame, key: str, ids: str, length: int, eos: int = EOS) -> DataFrame:
    """Fixed-length blocks of the end-to-end token stream, the last one short."""
    pieces = block_pieces(durable(df), key, ids, length, eos)
    ordered = F.array_sort(F.collect_list(F.struct("at", "piece")))
    return pieces.groupBy("block").agg(F.flatten(F.transform(ordered, lambda s: s["piece"])).alias("ids"))


def window_start(window: Column, seed: int, total: int, length: int) -> Column:
    """A drawn place of `length` tokens in a stream of `total`; every place can be drawn, at any size."""
    return F.pmod(hash_key(window, seed, WIDE_BITS), F.lit(max(1, total - length + 1)).cast("bigint"))


def calibration_windows(df: DataFrame, key: str, ids: str, count: int, length: int, seed: int) -> DataFrame:
    """`count` windows of `length` tokens from hash-drawn places in the token stream.

    A window touches two neighbouring blocks at most and meets its pieces on
    the block number. A stream shorter than a window is one short window.
    """
    stored = durable(df)
    total = stored.agg(F.sum(F.size(ids) + 1)).first()[0]
    starts = df.sparkSession.range(count).select(
        F.col("id").alias("window"),
        window_start(F.col("id"), seed, total, length).alias("start"),
    )
    reach = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + length - 1) / length))
    wanted = starts.withColumn("block", F.explode(reach))
    hit = block_pieces(stored, key, ids, length).join(wanted, "block")
    begin = F.greatest("at", "start")
    size = F.least(F.col("at") + F.size("piece"), F.col("start") + length) - begin
    inside = hit.withColumn("size", size.cast("int")).filter("size > 0")
    part = F.slice("piece", (begin - F.col("at") + 1).cast("int"), F.col("size"))
    ordered = F.array_sort(F.collect_list(F.struct(begin.alias("at"), part.alias("part"))))
    return inside.groupBy("window", "start").agg(F.flatten(F.transform(ordered, lambda s: s["part"])).alias("ids"))


def batch_ids(df: DataFrame, order: str, size: int) -> DataFrame:
    """Positional batches of `size` rows."""
    return dense_index(df, order, "row_idx").withColumn("batch", F.floor(F.col("row_idx") / size))
