"""Repeated byte strings by a logarithmic family of sparse suffix arrays.

A full suffix array sorts a suffix for every byte. Repeats of `length` bytes or
more need fewer: each window of that length is assigned to the suffix that
starts at its smallest hashed group of bytes, the leftmost of equals, so equal
windows are assigned to suffixes that start with the same bytes, at the same
place in the window. About one suffix in ninety bytes is kept. An entry of the
array is a suffix (named by its leading bytes' hash) with the stretch of text
its windows cover (named by the stretch's hash) and how often it occurs.

New batches of documents get arrays of their own, sorted by suffix; equal-sized
levels of the family are merged, so an entry is rewritten log2(batches) times;
a level counts a suffix. A scan of the sorted family tells the suffixes that occur once from those that
occur again. A stretch found twice is repeated as a whole. Where a suffix has
several different stretches, and only there, their windows are compared; of a
stretch found often one copy takes part. A stretch sends its bytes, which take
less room than the hashes of its windows; a suffix with very many stretches is
cut by the value of those hashes, which are then sent, so equal windows still
meet and no task holds more than a bounded part. Groups of copies, however large, are counted, never gathered.

Matches do not cross documents; all occurrences count, also in the same row's
text and overlapping. Rows are told apart by id and text hash and counted, so
repeated rows are occurrences of their own. A null text is empty. A null id is
a document like any other. Texts are read in overlapping chunks, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, collect_garbage, discard, map_batches, utf8, values
from textloom.llm.simhash import mix
from textloom.llm.substring import keyed, sliding_min, tag_of

GROUP = 16  # bytes of a group
CHUNK = 1 << 19  # windows looked at together
PLACE_BITS = 20
TAG_BITS, RUN_BITS = 24, 8  # a run is its first window, its number of windows, and a tag of the text
TOGETHER = 2048  # stretches of one suffix that are compared in one group
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[0])  # a hash of each byte value


def group_hashes(part: bytes) -> np.ndarray:
    """A hash of every 16 consecutive bytes."""
    n = len(part) - 7
    eight = np.empty(n, dtype=np.uint64)
    for k in range(min(8, n)):
        eight[k::8] = np.frombuffer(part, "<u8", (n - k + 7) // 8, k)
    with np.errstate(over="ignore"):
        return mix(mix(eight[:-8] * _ODD[0]) + eight[8:] * _ODD[1])


def suffixes(text: bytes, length: int):
    """`(anchor, first, n, stretch)` arrays: `n` windows from `first` on belong to one suffix; `stretch` hashes their bytes."""
    import xxhash

    anchors, firsts, counts, stretches = [], [], [], []
    windows = len(text) - length + 1
    place = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, windows, CHUNK):
        part = text[at : at + CHUNK + length - 1]
        hashes = group_hashes(part)
        keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_min(keys, length - GROUP + 1)
        starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        ends = np.concatenate([starts[1:], [len(least)]])
        anchors.append(hashes[(least[starts] & place).astype(np.int64)])
        firsts.append(starts + at)
        counts.append(ends - starts)
        stretches.append(
            np.fromiter(
                (xxhash.xxh3_64_intdigest(part[a : b + length - 1]) for a, b in zip(starts.tolist(), ends.tolist())),
                np.uint64, len(starts),
            )
        )
    return tuple(map(np.concatenate, (anchors, firsts, counts, stretches)))


_ENTRY = "id long, anchor long, stretch long, run long"


def _suffixes(batches, length):
    names = ("id", "anchor", "stretch", "run")
    for batch in batches:
        ids, tags = values(batch, "id"), values(batch, "tag")
        out, held = [], 0
        for k, text in enumerate(utf8(batch, "text")):
            if text is None or len(text) < length:
                continue
            anchor, first, n, stretch = suffixes(text, length)
            run = (first << TAG_BITS + RUN_BITS) + (n << TAG_BITS) + tags[k]
            out.append((np.full(len(n), ids[k]), anchor.view(np.int64), stretch.view(np.int64), run))
            held += len(n)
            if held > 100_000:
                yield dict(zip(names, map(np.concatenate, zip(*out))))
                out, held = [], 0
        if out:
            yield dict(zip(names, map(np.concatenate, zip(*out))))


class LevelFamily:
    """Sorted tables of `(anchor, found)`; two levels of the same rank become one of the next."""

    def __init__(self):
        self.levels: list[tuple[int, Stored]] = []

    def add(self, entries: DataFrame) -> None:
        """Take in one batch of rows with an `anchor`."""
        counted = entries.groupBy("anchor").agg(F.count("*").alias("found"))
        self._push(0, Stored(counted.sortWithinPartitions("anchor"), "level"))

    def _push(self, rank: int, level: Stored) -> None:
        while self.levels and self.levels[-1][0] == rank:
            other = self.levels.pop()[1]
            merged = Stored(_merged([other.df, level.df]).sortWithinPartitions("anchor"), "level")
            discard(other, level)
            rank, level = rank + 1, merged
        self.levels.append((rank, level))

    def shared(self) -> DataFrame:
        """The suffixes that occur again, over all levels."""
        return _merged([level.df for _, level in self.levels]).filter("found > 1").select("anchor")


def _merged(tables: Sequence[DataFrame]) -> DataFrame:
    if len(tables) == 1:
        return tables[0]
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("anchor").agg(F.sum("found").alias("found"))


def _windows(batches, length):
    """Each wanted stretch as its bytes; where its suffix has several parts, as the hashes and places of its windows for each part."""
    names = ("anchor", "part", "id", "tag", "weight", "first", "places", "data")
    for batch in batches:
        ids, tags = values(batch, "id"), values(batch, "tag")
        lists = [values(batch, c) for c in ("anchors", "runs", "partss", "weights")]
        rows, held = [], 0
        for k, text in enumerate(utf8(batch, "text")):
            for anchor, run, parts, weight in sorted(set(zip(*(column[k] for column in lists)))):
                first, n = run >> TAG_BITS + RUN_BITS, run >> TAG_BITS & (1 << RUN_BITS) - 1
                part = text[first : first + n + length - 1]
                if parts == 1:
                    rows.append((anchor, 0, ids[k], tags[k], weight, first, None, part))
                else:
                    hashes = window_hashes(part, length)
                    dealt = (hashes % np.uint64(parts)).astype(np.int64)
                    for p in np.unique(dealt).tolist():
                        here = np.flatnonzero(dealt == p)
                        rows.append((anchor, p, ids[k], tags[k], weight, first, here.astype("<i4").tobytes(), hashes[here].tobytes()))
                held += n
            if held > 200_000:
                yield dict(zip(names, zip(*rows)))
                rows, held = [], 0
        if rows:
            yield dict(zip(names, zip(*rows)))


def _compare(batches, length):
    """Ranges of the windows that occur again, of stretches that weigh one; rows come sorted by suffix and part.

    Equal windows have the same suffix and part, so whole groups are compared together, some at a time.
    """
    held, windows, last = [], 0, None

    def hashes_and_places():
        """For the held rows, bytes first: the window hashes, their places, and their numbers in each row."""
        joined = b"".join(r[5] for r in held if r[4] is None)
        sizes = np.array([len(r[5]) for r in held if r[4] is None], dtype=np.int64)
        counts = sizes - length + 1
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = [window_hashes(joined, length)[np.repeat(np.cumsum(sizes) - sizes, counts) + within]] if joined else []
        places = [within]
        cut = [r for r in held if r[4] is not None]
        hashes += [np.frombuffer(r[5], np.uint64) for r in cut]
        places += [np.frombuffer(r[4], "<i4") for r in cut]
        counts = np.concatenate([counts, [len(r[5]) // 8 for r in cut]]).astype(np.int64)
        return np.concatenate(hashes), np.concatenate(places).astype(np.int64), counts

    def ranges():
        held.sort(key=lambda r: r[4] is not None)
        hashes, places, sizes = hashes_and_places()
        places += np.repeat(np.array([r[3] for r in held], dtype=np.int64), sizes)
        weight = np.repeat(np.array([r[2] for r in held]), sizes)
        row = np.repeat(np.arange(len(held)), sizes)
        _, at = np.unique(hashes, return_inverse=True)
        again = (np.bincount(at, weights=weight)[at] > 1) & (weight == 1)
        places, row = places[again], row[again]
        if not len(places):
            return None
        new = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(row) != 0)]))
        ends = np.concatenate([new[1:], [len(places)]])
        return {
            "id": [held[r][0] for r in row[new].tolist()], "tag": [held[r][1] for r in row[new].tolist()],
            "start": places[new], "size": ends - new + length - 1,
        }

    for batch in batches:
        for anchor, part, *row in zip(*(values(batch, c) for c in ("anchor", "part", "id", "tag", "weight", "first", "places", "data"))):
            if (anchor, part) != last:
                if windows > 500_000:
                    if (found := ranges()) is not None:
                        yield found
                    held, windows = [], 0
                last = (anchor, part)
            held.append(row)
            windows += len(row[5]) - length + 1 if row[4] is None else len(row[5]) // 8
    if held and (found := ranges()) is not None:
        yield found


def window_hashes(part: bytes, length: int) -> np.ndarray:
    """A hash of every window, from polynomial prefix sums over hashed bytes."""
    data = np.frombuffer(part, np.uint8)
    power, inverse = (column[: len(data)] for column in _powers(1 << (len(data) - 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power)])
        # A window's sum carries the power of its start, which the inverse takes out.
        return mix((sums[length:] - sums[:-length]) * inverse[: len(data) - length + 1])


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_ODD[0]), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _ODD[0])), np.cumprod(np.full(n, inverse))


def repeated_ranges(docs: DataFrame, length: int = 200, batches: int = 2, passes: int = 1) -> tuple[DataFrame, Stored]:
    """`keyed(docs)`, and for its `(id, tag)` the repeated ranges as lists `starts` and `sizes`."""
    if length - GROUP >= 1 << RUN_BITS:
        raise ValueError(f"runs count up to {(1 << RUN_BITS) - 1} windows")
    texts = keyed(docs, TAG_BITS)
    rows = texts.select("id", "tag", "text")
    entries = Stored(map_batches(rows, _suffixes, _ENTRY, length=length), "suffixes")
    family = LevelFamily()
    for k in range(batches):
        family.add(entries.df.filter(F.pmod("id", F.lit(batches)) == k).select("anchor"))
    near = Stored(entries.df.join(family.shared(), "anchor"), "shared")
    discard(entries, *[level for _, level in family.levels])

    stretches = near.df.groupBy("anchor", "stretch").agg(F.count("*").alias("found"), F.min("id").alias("rep"))
    stretches = Stored(stretches, "stretches")
    kinds = stretches.df.groupBy("anchor").agg(F.count("*").alias("kinds"))
    known = stretches.df.join(kinds, "anchor").filter("found > 1 or kinds > 1")
    # Where a suffix has several stretches: those found once, and one copy of those found more often, which weighs two.
    marked = near.df.join(known, ["anchor", "stretch"]).select(
        "id", "anchor", "run", F.least(F.col("found"), F.lit(2)).cast("int").alias("weight"),
        F.when(F.expr("kinds > 1 and (found = 1 or id = rep)"), F.ceil(F.col("kinds") / TOGETHER)).cast("int").alias("parts"),
    )
    marked = Stored(marked, "marked")
    discard(near, stretches)
    first = F.shiftright("run", TAG_BITS + RUN_BITS)
    n = F.shiftright("run", TAG_BITS).bitwiseAND(F.lit((1 << RUN_BITS) - 1))
    whole = marked.df.filter("weight = 2").select(
        "id", tag_of("run", TAG_BITS), first.alias("start"), (n + length - 1).alias("size")
    )
    compared = marked.df.filter("parts is not null").select("id", tag_of("run", TAG_BITS), "anchor", "run", "parts", "weight")
    schema = "anchor long, part int, id long, tag int, weight int, first int, places binary, data binary"
    hits = []
    for k in range(passes):  # a share of the suffixes at a time, so that the hashes of all windows are never on disk together
        share = compared.filter(F.pmod("anchor", F.lit(passes)) == k).groupBy("id", "tag")
        lists = share.agg(*(F.collect_list(c).alias(f"{c}s") for c in ("anchor", "run", "parts", "weight")))
        windows = map_batches(rows.join(lists, ["id", "tag"]), _windows, schema, length=length)
        windows = windows.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
        hits.append(Stored(map_batches(windows, _compare, "id long, tag long, start long, size long", length=length), "hits"))
        collect_garbage(rows.sparkSession)
    for more in hits:
        whole = whole.unionByName(more.df)
    ranges = whole.groupBy("id", "tag").agg(
        F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes")
    )
    ranges = Stored(ranges, "ranges")
    discard(marked, *hits)
    return texts, ranges


def merged_ranges(starts: Sequence[int], sizes: Sequence[int]) -> list[tuple[int, int]]:
    """Maximal `(start, end)` runs of the union."""
    order = np.argsort(np.asarray(starts), kind="stable")
    first = np.asarray(starts, dtype=np.int64)[order]
    last = np.maximum.accumulate(first + np.asarray(sizes, dtype=np.int64)[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    ends = last[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(last) - 1]])]
    return list(zip(first[new].tolist(), ends.tolist()))


def without_repeated_bytes(docs: DataFrame, length: int = 200, batches: int = 2, with_kept: bool = True) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept)` of each row of `docs(doc_id, text)`.

    `spans` are the removed runs as flat `start, end` pairs; `kept` the bytes
    left; both are null without `with_kept`.
    """
    texts, ranges = repeated_ranges(docs, length, batches)
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"
    )
    rows = texts.join(ranges.df, ["id", "tag"], "left").select("doc_id", "text", "starts", "sizes")
    return map_batches(rows, _cut, schema, with_kept=with_kept)


def _cut(batches, with_kept):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")
    for batch in batches:
        rows = []
        starts, sizes = values(batch, "starts"), values(batch, "sizes")
        for k, (doc_id, text) in enumerate(zip(values(batch, "doc_id"), utf8(batch, "text"))):
            text = text or b""
            gone = merged_ranges(starts[k], sizes[k]) if starts[k] else []
            parts, at = [], 0
            for start, end in gone:
                parts.append(text[at:start])
                at = end
            kept = b"".join([*parts, text[at:]])
            found = ([x for span in gone for x in span], kept) if with_kept else (None, None)
            rows.append((doc_id, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), *found))
        yield dict(zip(names, zip(*rows)))
