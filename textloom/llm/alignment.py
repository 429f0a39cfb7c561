"""Alignment of two tokenizers over the bytes of every text.

A byte-level tokenizer (A) and a piece tokenizer (B) cut the same bytes, a space
and the text, in different places. All tokens of both are sorted by their start
(`lexsort`), the running maximum of their ends is taken (`maximum.accumulate`),
and a group ends where a start reaches that maximum: there both sides have a
boundary. Inside a group every two tokens that overlap are expanded, and those
that also end together are links.

A link's id pair is counted over the whole corpus. The texts are encoded once,
in blocks of whole documents of about `LINKS_PER_BLOCK` links; a block stores
its distinct pairs once and each document's links as places among them. Only
the distinct pairs of blocks are counted by a combining aggregate, joined with
their totals, and sent back to their block, so that the frequent pairs are one
row a block and no document's links are shuffled by pair. A block is a bounded
group, or one document where that alone is larger.

Texts that are null, empty, or not given back by both tokenizers byte for byte
(B takes the character U+2581 for a space) have no tokens and no links. Strings
of special tokens inside a text are plain text. Rows with null or repeated ids
are documents like any other. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, discard, map_batches, values

LINKS_PER_BLOCK = 2_000_000
BYTES_TOGETHER = 1 << 20  # texts aligned by one set of arrays
B_BITS = 32
SPACE_MARK = "▁"  # fixed value: how piece tokenizers write a space

# Fixed value: where a byte-level tokenizer cuts text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs array<long>, uses array<long>"


def byte_of_character() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes bytes with: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Ids of a byte-level tokenizer file, and the bytes of every id.

    The file's merges are in the order of the ids they make, so its vocabulary is a table of ranks.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        added = {token["content"] for token in data["added_tokens"]}
        vocabulary = {k: v for k, v in data["model"]["vocab"].items() if k not in added}
        made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in data["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        byte = byte_of_character()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes[k] = bytes(byte[c] for c in token)
        ranks = {self.bytes[k]: k for k in vocabulary.values()}
        self.encoding = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        try:
            return self.encoding.encode_ordinary(text)
        except BaseException as error:  # its matcher gives up on very long runs of white space
            if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                raise
            return self._plain().encode(text, add_special_tokens=False).ids

    def _plain(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer


class PieceTokens:
    """Ids of a piece tokenizer model, which adds a space before the text, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(k) else piece.replace(SPACE_MARK, " ").encode()
            for k, piece in enumerate(self.model.id_to_piece(list(range(self.model.get_piece_size()))))
        ]

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


@lru_cache(maxsize=2)
def _loaded(a_path: str, b_path: str):
    """Both tokenizers, once for each worker process; the bytes' lengths; each id as decimal text with what follows it."""
    a, b = ByteTokens(a_path), PieceTokens(b_path)
    lengths = [np.array([len(x) for x in side.bytes], dtype=np.int64) for side in (a, b)]
    follows = [f"{k}{mark}" for k in range(max(map(len, lengths))) for mark in ",|;"]
    return a, b, lengths, follows


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval: a new one begins where a start reaches the largest end before it."""
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    number = np.zeros(len(order), dtype=np.int64)
    number[1:] = np.cumsum(starts[order][1:] >= reached[:-1])
    group = np.empty_like(number)
    group[order] = number
    return group


def overlaps(a_starts, a_ends, b_starts, b_ends) -> tuple[np.ndarray, np.ndarray]:
    """Every two of the A and B intervals that overlap, as places; each side is in order and without overlaps of its own."""
    first = np.searchsorted(b_ends, a_starts, side="right")
    n = np.searchsorted(b_starts, a_ends, side="left") - first
    a = np.repeat(np.arange(len(a_starts)), n)
    within = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    return a, np.repeat(first, n) + within


class Aligned:
    """The alignment of some texts: tokens of all texts in arrays, and where each text begins in them."""

    def __init__(self, texts: Sequence[str | None], a_path: str, b_path: str):
        a_side, b_side, (a_bytes, b_bytes), self.follows = _loaded(a_path, b_path)
        wholes = [(" " + t).encode() if t else b"" for t in texts]
        pairs = []
        for text, whole, b_ids in zip(texts, wholes, b_side.ids([t or "" for t in texts])):
            a_ids = a_side.ids(" " + text) if text else []
            given_back = b"".join(map(a_side.bytes.__getitem__, a_ids)) == whole == b"".join(map(b_side.bytes.__getitem__, b_ids))
            pairs.append((a_ids, b_ids) if given_back else ([], []))
        self.a, self.a_from = _joined([a for a, _ in pairs])
        self.b, self.b_from = _joined([b for _, b in pairs])
        # Both sides of a text end at the same byte, so texts laid end to end share no group.
        self.a_ends, self.b_ends = np.cumsum(a_bytes[self.a]), np.cumsum(b_bytes[self.b])
        self.a_starts, self.b_starts = self.a_ends - a_bytes[self.a], self.b_ends - b_bytes[self.b]
        group = coalesce(np.concatenate([self.a_starts, self.b_starts]), np.concatenate([self.a_ends, self.b_ends]))
        self.a_group, self.b_group = group[: len(self.a)], group[len(self.a) :]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and B tokens that overlap and end together, in order, and where each text begins in them."""
        a, b = overlaps(self.a_starts, self.a_ends, self.b_starts, self.b_ends)
        together = self.a_ends[a] == self.b_ends[b]
        a, b = a[together], b[together]
        return a, b, np.searchsorted(a, self.a_from)

    def n_groups(self) -> np.ndarray:
        """The number of groups of each text."""
        last = np.concatenate([self.a_group, [self.a_group[-1] + 1 if len(self.a_group) else 0]])
        return np.diff(last[self.a_from])

    def group_texts(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each text: ids of both sides by group; empty without tokens."""
        ids = np.concatenate([self.a, self.b])
        group = np.concatenate([self.a_group, self.b_group])
        side = np.repeat([0, 1], [len(self.a), len(self.b)])
        order = np.lexsort((side, group))  # stable: tokens stay in order
        ids, group, side = ids[order], group[order], side[order]
        mark = np.full(len(ids), 2)
        mark[:-1] = np.where(group[1:] > group[:-1], 2, side[1:] - side[:-1])
        parts = list(map(self.follows.__getitem__, (3 * ids + mark).tolist()))
        bounds = (self.a_from + self.b_from).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def _joined(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=int(starts[-1])), starts


def _groups_of(texts: Sequence, most: int):
    """Runs of texts of about `most` characters, a longer text alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def _encode(batches, a_path, b_path, links_per_block):
    """Rows of documents and, after those of a block, the row of its distinct pairs."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    docs, codes, held = [], [], 0
    for batch in batches:
        ids, texts = values(batch, "doc_id"), values(batch, "text")
        for x, y in _groups_of(texts, BYTES_TOGETHER):
            found = Aligned(texts[x:y], a_path, b_path)
            a, b, starts = found.links()
            pairs = (found.a[a] << B_BITS) | found.b[b]
            n_a, n_b = np.diff(found.a_from).tolist(), np.diff(found.b_from).tolist()
            for i, (groups, n_groups) in enumerate(zip(found.group_texts(), found.n_groups().tolist())):
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                docs.append((ids[x + i], n_a[i], n_b[i], n_groups, int(starts[i + 1] - starts[i]), digest))
            codes.append(pairs)
            held += len(pairs) + y - x
            if held >= links_per_block:
                yield from _block(block, docs, codes)
                block, docs, codes, held = block + 1, [], [], 0
    if docs:
        yield from _block(block, docs, codes)


def _block(block, docs, codes):
    distinct, place, uses = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    place = place.astype("<u4")
    ids, n_a, n_b, n_groups, n_links, digests = zip(*docs)
    ends = np.cumsum(n_links)
    n = len(docs)
    for x in range(0, n, 4096):
        part = slice(x, x + 4096)
        rows = len(ids[part])
        yield {
            "block": [block] * rows, "doc_id": ids[part], "n_a": n_a[part], "n_b": n_b[part], "n_groups": n_groups[part],
            "n_links": n_links[part], "groups_sha256": digests[part],
            "links": [place[e - k : e].tobytes() for e, k in zip(ends[part].tolist(), n_links[part])],
            "pairs": [None] * rows, "uses": [None] * rows,
        }
    nothing = {name: [None] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")}
    yield {"block": [block], **nothing, "pairs": [distinct.tolist()], "uses": [uses.tolist()]}


def _sums(places: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
    """Of each document of a block the links that are their B id's most frequent, and the sum of its links' counts."""
    count, best = np.zeros(len(places), dtype=np.int64), np.zeros(len(places), dtype=np.int64)
    at = places["at"].to_numpy()
    count[at], best[at] = places["count"].to_numpy(), places["best"].to_numpy()
    links = [np.frombuffer(row, dtype="<u4") for row in docs["links"]]
    out = docs.drop(columns=["of_block", "links"])
    out["n_best"] = [int(best[row].sum()) for row in links]
    out["count_sum"] = [int(count[row].sum()) for row in links]
    return out


def pair_counts(blocks: DataFrame) -> DataFrame:
    """`(pair, count, best)` over the corpus; `best` is 1 where no other pair of that B id is more frequent."""
    uses = blocks.select(F.arrays_zip("pairs", "uses").alias("rows")).select(F.inline("rows"))
    counts = uses.groupBy(F.col("pairs").alias("pair")).agg(F.sum("uses").alias("count"))
    counts = Stored(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))), "pairs").df
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, links_per_block: int = LINKS_PER_BLOCK) -> DataFrame:
    """Each row of `docs(doc_id, text)`: tokens of both sides, groups, links, and how frequent its links' pairs are."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = Stored(map_batches(texts, _encode, _BLOCKS, a_path=a_path, b_path=b_path, links_per_block=links_per_block), "aligned").df
    of_docs = encoded.filter("pairs is null").select(F.col("block").alias("of_block"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    of_blocks = encoded.filter("pairs is not null").select("block", "pairs", "uses")
    places = of_blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    places = places.join(pair_counts(of_blocks), "pair").select("block", "at", "count", "best")
    columns = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return places.groupBy("block").cogroup(of_docs.groupBy("of_block")).applyInPandas(_sums, columns)
