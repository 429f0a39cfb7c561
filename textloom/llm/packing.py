"""Best-fit packing with certified bin counts.

Documents longer than a sequence are cut into full pieces (the first piece is
the short one); full pieces are sequences of their own. What is left, pieces
shorter than a sequence, is dealt to partitions of a bounded number of pieces.
Each partition packs best-fit decreasing and computes lower bounds from dual-
feasible functions over its lengths. A partition whose bin count equals the
bound is certified optimal and closed. The others release their bins that are
not full; released bins meet bins of other partitions in new partitions, whose
pieces are packed again, and the new packing is taken where it needs fewer
bins. This ends when all are certified, or after `rounds`.

Empty and null texts are one piece of the end id. Repeated rows are packed as
often as they occur. A null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, discard, map_batches, values
from textloom.llm.tokenizing import ID_BYTES, PieceEncoder

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PACKED = "part long, uid long, piece int, length long, bin long, offset long, gap long"
_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False, most_known: int = 1_500_000
) -> DataFrame:
    """The pieces of `docs(doc_id, text)`; `uid` tells repeated rows apart. A task keeps the ids of `most_known` words at most."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    form = {"path": tokenizer, "capacity": capacity, "end_id": end_id, "with_ids": with_ids, "most_known": most_known}
    return map_batches(rows, _pieces, PIECES, **form)


def _pieces(batches, path, capacity, end_id, with_ids, most_known):
    known, end = PieceEncoder(path, most_known), int(end_id).to_bytes(ID_BYTES, "little")
    rows, held = [], 0
    for batch in batches:
        texts = [text or "" for text in values(batch, "text")]
        for uid, doc_id, ids in zip(values(batch, "uid"), values(batch, "doc_id"), known.encode(texts)):
            ids += end
            n = len(ids) // ID_BYTES
            starts = [0, *range(n % capacity or capacity, n, capacity)]
            for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                part = ids[a * ID_BYTES : b * ID_BYTES]
                rows.append((uid, doc_id, k, a, b - a, zlib.crc32(part), part if with_ids else None))
            held += len(ids) if with_ids else 64
            if held > 8 << 20:
                yield dict(zip(_NAMES, zip(*rows)))
                rows, held = [], 0
    if rows:
        yield dict(zip(_NAMES, zip(*rows)))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length; equal lengths are told apart by their position.

    Open bins are kept by room left. A bit set of the rooms in use finds the
    smallest room that is large enough.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, opened = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for at, need in zip(order.tolist(), lengths[order].tolist()):
        fitting = in_use >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                in_use ^= 1 << room
        else:
            room, chosen = capacity, opened
            opened += 1
        bins[at] = chosen
        left = room - need
        if left:
            if not rooms[left]:
                in_use |= 1 << left
            rooms[left].append(chosen)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of three families of dual-feasible-function bounds.

    Of x in (0, 1], with thresholds over all halves e: x itself; x rounded to
    multiples of 1/k; and 1 for x > 1 - e, 0 for x < e, x between.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total = int(counts @ sizes)
    best = -(-total // capacity)
    for k in range(1, 41):  # u(k): x (k + 1) whole stays x, else floor((k + 1) x) / k; scaled by k * capacity
        scaled = (k + 1) * sizes
        u = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int(counts @ u) // (k * capacity)))
    at_most = np.concatenate([[0], np.cumsum(counts * sizes)])
    n_over = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # lengths >= i
    cuts = np.arange(1, capacity // 2 + 1)
    large = n_over[np.minimum(capacity - cuts + 1, capacity + 1)]
    between = at_most[capacity - cuts + 1] - at_most[cuts]
    return max(best, int(np.max(large + -(-between // capacity))))


def pack(short: DataFrame, capacity: int, pieces_per_part: int = 50_000, rounds: int = 4) -> Stored:
    """Stored bins of `short(uid, piece, length)`: `part` and `bin` name a sequence, `offset` the place in it.

    Partitions hold about `pieces_per_part` pieces whatever the table's size;
    a release of bins is by whole bins, so the new packing never needs more.
    """
    n = short.count()
    parts = max(1, math.ceil(n / pieces_per_part))
    dealt = short.select(
        F.pmod(F.xxhash64("uid", "piece"), F.lit(parts)).alias("part"),
        "uid", "piece", F.col("length").cast("long").alias("length"),
        F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("gap"),
    )
    state = Stored(dealt.groupBy("part").applyInPandas(_packer(capacity, 0), PACKED), "bins")
    for turn in range(1, rounds + 1):
        # A partition with a gap gives up its bins that are not full; `gap` is on their rows alone.
        open_rows = state.df.filter("gap > 0")
        n_open = open_rows.count()
        if not n_open:
            break
        parts = max(1, math.ceil(n_open / pieces_per_part))
        # A bin is named anew by (part, bin), so bins of several partitions stay apart.
        fresh = open_rows.select(
            (F.pmod(F.xxhash64("part", "bin", F.lit(turn)), F.lit(parts)) + (turn << 40)).alias("__to"),
            F.col("part").alias("was_part"), F.col("bin").alias("was_bin"), "uid", "piece", "length",
        )
        again = fresh.groupBy("__to").applyInPandas(_packer(capacity, turn), PACKED)
        after = Stored(state.df.filter("gap = 0").unionByName(again), "bins")
        before_bins, after_bins = (s.df.filter("offset = 0").count() for s in (state, after))
        discard(state)
        state = after
        if after_bins == before_bins:
            break
    return state


def _packer(capacity: int, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        part = rows["part"].iloc[0] if turn == 0 else rows["__to"].iloc[0]
        bound = lower_bound(lengths, capacity)
        if turn:
            was = rows.groupby(["was_part", "was_bin"], sort=False).ngroup().to_numpy()
            if was.max() <= bins.max():  # no gain: the bins as they were
                bins = was
        order = np.lexsort((-lengths, bins))
        ordered = lengths[order]
        sums = np.cumsum(ordered) - ordered
        first = np.r_[True, np.diff(bins[order]) != 0]
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = sums - np.maximum.accumulate(np.where(first, sums, 0))
        n_bins = int(bins.max()) + 1
        filled = np.bincount(bins, weights=lengths, minlength=n_bins)
        gap = np.where(filled[bins] < capacity, n_bins - bound, 0)
        return pd.DataFrame(
            {"part": part, "uid": rows["uid"], "piece": rows["piece"], "length": lengths, "bin": bins, "offset": offset, "gap": gap}
        )

    return run


def best_fit_sequences(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, pieces_per_part: int = 50_000,
    rounds: int = 4, with_ids: bool = False, task_bytes: int = 128 << 20, most_known: int = 1_500_000,
) -> DataFrame:
    """Every piece of `docs(doc_id, text)` with its sequence and place there.

    A task encodes about `task_bytes` of text, so that the words it has met pay
    off; scan splits are put together for that, nothing is shuffled.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.coalesce(max(1, math.ceil(size / task_bytes)))
    cut = Stored(pieces(docs, tokenizer, capacity, end_id, with_ids, most_known), "pieces")
    short = pack(cut.df.filter(F.col("length") < capacity), capacity, pieces_per_part, rounds)
    full = cut.df.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    full = full.withColumn("offset", F.lit(0).cast("long"))
    heads = short.df.filter("offset = 0").select("part", "bin", F.monotonically_increasing_id().alias("sequence_id"))
    placed = short.df.join(heads, ["part", "bin"]).select("uid", "piece", "sequence_id", "offset")
    rest = cut.df.filter(F.col("length") < capacity).join(placed, ["uid", "piece"])
    return rest.unionByName(full)
