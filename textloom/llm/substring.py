"""Repeated passages by relative Lempel-Ziv parsing.

The reference is the corpus itself, cut into blocks by content: a window of
`window` words belongs to the block of its anchor, the smallest hash of the
word groups in it, so equal windows always meet in the same block, wherever
they stand. A block whose anchor occurs in one document only cannot hold a
repeat and is dropped before any text moves; about one anchor in five words is
looked at, not every window. Consecutive windows with one anchor are a stretch.
A stretch that an earlier document holds is repeated as a whole; only where an
anchor has several different stretches are their windows compared, those of the
first document that holds the stretch. Groups of copies are counted, not
gathered.

A document is parsed against all blocks that hold its anchors: at each word the
factor is the longest run of windows that the same earlier document holds, and
windows that straddle two factors are probed like all others, so nothing is
missed at factor boundaries. Factors are at least one window long and become
the duplicate spans.

An earlier document has a smaller id; a null id counts as the largest. Rows
with the same id never remove each other's words. Null texts have no words.
Rows are told apart by id and a hash of their text, so repeated rows get the
same result. Windows are compared by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, discard, id_or_last, map_batches, utf8, values
from textloom.llm.simhash import mix

GROUP = 5  # words of an anchor
TAG_BITS, RUN_BITS = 32, 4  # a run is its first window, its number of windows, and a tag of the text
_LISTS = ("starts", "counts", "owners")
_PAD = np.random.default_rng(13).integers(1, 1 << 63, size=(3, 64), dtype=np.int64).astype(np.uint64) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, size: int, row: int) -> np.ndarray:
    """A hash of every `size` consecutive values, by multipliers of their own for each place."""
    n = len(hashes) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total += hashes[k : k + n] * _PAD[row, k]
    return mix(total)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every `size` consecutive values, by doubling."""
    done, span = x, 1
    while 2 * span <= size:
        done = np.minimum(done[:-span], done[span:])
        span *= 2
    rest = size - span
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def runs_of(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values, runs over `most` cut."""
    starts = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1])
    lengths = np.diff(np.concatenate([starts, [len(x)]]))
    if lengths.max() > most:
        pieces = [np.arange(s, s + n, most) for s, n in zip(starts, lengths)]
        starts = np.concatenate(pieces)
        lengths = np.diff(np.concatenate([starts, [len(x)]]))
    return starts, lengths


def _anchors(batches, window):
    names = ("id", "anchor", "stretch", "run")
    most = min(window, (1 << RUN_BITS) - 1)  # the first and the last window then cover the words of all
    for batch in batches:
        ids, tags = values(batch, "id"), values(batch, "tag")
        out, held = [], 0
        for k, text in enumerate(utf8(batch, "text")):
            words = (text or b"").split()
            if len(words) < window:
                continue
            hashes = word_hashes(words)
            anchor = sliding_min(rolling(hashes, GROUP, 0), window - GROUP + 1)
            whole = rolling(hashes, window, 1)
            starts, n = runs_of(anchor, most)
            with np.errstate(over="ignore"):
                stretch = mix(whole[starts] * _PAD[2, 0] + whole[starts + n - 1] * _PAD[2, 1] + n.astype(np.uint64))
            run = (starts << TAG_BITS + RUN_BITS) + (n << TAG_BITS) + tags[k]
            out.append((np.full(len(n), ids[k]), anchor[starts].view(np.int64), stretch.view(np.int64), run))
            held += len(n)
            if held > 100_000:
                yield dict(zip(names, map(np.concatenate, zip(*out))))
                out, held = [], 0
        if out:
            yield dict(zip(names, map(np.concatenate, zip(*out))))


def _windows(batches, window):
    names = ("h1", "h2", "id", "tag", "at")
    for batch in batches:
        ids, tags, runs = values(batch, "id"), values(batch, "tag"), values(batch, "runs")
        out, held = [], 0
        for k, text in enumerate(utf8(batch, "text")):
            wanted = np.unique(np.array(runs[k], dtype=np.int64)) >> TAG_BITS
            starts, n = wanted >> RUN_BITS, wanted & ((1 << RUN_BITS) - 1)
            at = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            words = word_hashes(text.split())
            h1, h2 = (rolling(words, window, row)[at].view(np.int64) for row in (1, 2))
            out.append((h1, h2, np.full(len(at), ids[k]), np.full(len(at), tags[k]), at))
            held += len(at)
            if held > 100_000:
                yield dict(zip(names, map(np.concatenate, zip(*out))))
                out, held = [], 0
        if out:
            yield dict(zip(names, map(np.concatenate, zip(*out))))


def keyed(docs: DataFrame, tag_bits: int = TAG_BITS) -> DataFrame:
    """`(doc_id, id, tag, text)`: id with null as the largest, and some bits of a hash of the text."""
    tag = F.xxhash64("text").bitwiseAND(F.lit((1 << tag_bits) - 1))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), id_or_last().cast("long").alias("id"), tag.alias("tag"), "text"
    )


def tag_of(run: str, tag_bits: int = TAG_BITS) -> Column:
    return F.col(run).bitwiseAND(F.lit((1 << tag_bits) - 1)).alias("tag")


def parse(docs: DataFrame, window: int = 13) -> DataFrame:
    """`keyed(docs)` with lists `starts`, `counts`, `owners`: windows from `start` on, `count` of them, that an earlier
    document holds, and the first that does."""
    texts = keyed(docs)
    rows = texts.select("id", "tag", "text")
    schema = "id long, anchor long, stretch long, run long"
    runs = Stored(map_batches(rows, _anchors, schema, window=window), "anchors")
    shared = runs.df.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    near = Stored(runs.df.join(shared.select("anchor"), "anchor"), "shared")
    discard(runs)
    stretches = Stored(near.df.groupBy("anchor", "stretch").agg(F.min("id").alias("rep")), "stretches")
    kinds = stretches.df.groupBy("anchor").agg(F.count("*").alias("kinds"))
    marked = near.df.join(stretches.df.join(kinds, "anchor"), ["anchor", "stretch"])
    marked = Stored(marked.filter("rep < id or kinds > 1").select("id", "run", "rep"), "marked")
    discard(near, stretches)
    first = F.shiftright("run", TAG_BITS + RUN_BITS)
    n = F.shiftright("run", TAG_BITS).bitwiseAND(F.lit((1 << RUN_BITS) - 1))
    whole = marked.df.filter("rep < id").select("id", tag_of("run"), first.alias("start"), n.alias("count"), F.col("rep").alias("owner"))

    compared = marked.df.filter("rep = id").select("id", tag_of("run"), "run")
    compared = compared.groupBy("id", "tag").agg(F.collect_list("run").alias("runs"))
    schema = "h1 long, h2 long, id long, tag long, at long"
    windows = Stored(map_batches(rows.join(compared, ["id", "tag"]), _windows, schema, window=window), "windows")
    owner = windows.df.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
    hits = windows.df.join(owner, ["h1", "h2"]).filter("owner < id")
    hits = hits.select("id", "tag", F.col("at").alias("start"), F.lit(1).cast("long").alias("count"), "owner")
    found = whole.unionByName(hits).groupBy("id", "tag").agg(
        *(F.collect_list(c).alias(f"{c}s") for c in ("start", "count", "owner"))
    )
    found = Stored(found, "found")
    discard(marked, windows)
    return texts.join(found.df, ["id", "tag"], "left")


def greedy_factors(starts: list, counts: list, owners: list, window: int) -> list[tuple[int, int, int]]:
    """`(start, n_words, owner)`: each factor goes on while the next windows have the same owner."""
    found: list[list[int]] = []
    for start, count, owner in sorted(set(zip(starts, counts, owners))):
        if found and found[-1][2] == owner and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], start + count)
        else:
            found.append([start, start + count, owner])
    return [(start, end - start + window - 1, owner) for start, end, owner in found]


def factors(docs: DataFrame, window: int = 13) -> DataFrame:
    """`(doc_id, start, n_words, reference_id)`: the duplicate spans, in words."""
    schema = "doc_id long, start long, n_words long, reference_id long"
    return map_batches(
        parse(docs, window).filter("starts is not null").select("doc_id", *_LISTS), _factors, schema, window=window
    )


def _factors(batches, window):
    for batch in batches:
        out = {"doc_id": [], "start": [], "n_words": [], "reference_id": []}
        for doc_id, *lists in zip(*(values(batch, c) for c in ("doc_id", *_LISTS))):
            for start, n, owner in greedy_factors(*lists, window):
                for name, value in zip(out, (doc_id, start, n, owner)):
                    out[name].append(value)
        yield out


def without_repeats(docs: DataFrame, window: int = 13, with_kept: bool = True) -> DataFrame:
    """`(doc_id, n_words, n_removed, kept_sha256, kept)` of each row; `kept` is its text without the duplicate
    spans, null without `with_kept`."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return map_batches(parse(docs, window).select("doc_id", "text", *_LISTS), _cut, schema, window=window, with_kept=with_kept)


def _cut(batches, window, with_kept):
    names = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    for batch in batches:
        rows = []
        lists = [values(batch, c) for c in _LISTS]
        for k, (doc_id, text) in enumerate(zip(values(batch, "doc_id"), utf8(batch, "text"))):
            words = (text or b"").split()
            n, removed = len(words), 0
            if lists[0][k]:
                gone = np.zeros(n, dtype=bool)
                for start, size, _ in greedy_factors(*(column[k] for column in lists), window):
                    gone[start : start + size] = True
                removed = int(gone.sum())
                words = [w for w, out in zip(words, gone.tolist()) if not out]
            kept = b" ".join(words)
            rows.append((doc_id, n, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if with_kept else None))
        yield dict(zip(names, zip(*rows)))
