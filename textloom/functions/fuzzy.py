"""String similarity scores, 0 to 100, over the pairs of a pair table.

Longest common subsequences run on machine-word bit vectors (Hyyro 2004), one
big integer per string, so that long texts stay affordable.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence of two sequences of hashables."""
    if len(a) > len(b):
        a, b = b, a
    where: dict = {}
    for i, item in enumerate(a):
        where[item] = where.get(item, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for item in b:
        hit = free & where.get(item, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def places_of(items: Sequence) -> dict:
    """The places of each item as the bits of one integer."""
    where: dict = {}
    for j, item in enumerate(items):
        where[item] = where.get(item, 0) | (1 << j)
    return where


def lcs_places(a: Sequence, b: Sequence, where: dict | None = None) -> list[int]:
    """Places in `a` of one longest common subsequence with `b`: read from the end, equal items are always matched,
    and where the rest is as long either way the item of `a` is left out. `where` is `places_of(b)`, if at hand."""
    where = places_of(b) if where is None else where
    full = (1 << len(b)) - 1
    taken, rows = 0, [0]  # bit j of a row: the common length grows at place j of b
    for item in a:
        hit = (full ^ taken) & where.get(item, 0)
        free = full ^ taken
        taken = full ^ (((free + hit) | (free - hit)) & full)
        rows.append(taken)
    found = []
    i, j, length = len(a), len(b), taken.bit_count()
    while length:
        if a[i - 1] == b[j - 1]:
            found.append(i - 1)
            i, j, length = i - 1, j - 1, length - 1
            continue
        without_b = length - (rows[i] >> (j - 1) & 1)
        without_a = (rows[i - 1] & ((1 << j) - 1)).bit_count()
        if without_b > without_a:
            j, length = j - 1, without_b
        else:
            i, length = i - 1, without_a
    return found[::-1]


def embedded_places(a: Sequence, b: Sequence) -> list[int] | None:
    """`lcs_places` of a `b` that is a subsequence of `a`: each item at its last possible place; None if it is not one."""
    found, i = [], len(a)
    for item in reversed(b):
        i -= 1
        while i >= 0 and a[i] != item:
            i -= 1
        if i < 0:
            return None
        found.append(i)
    return found[::-1]


def union_hits(reference: Sequence[Sequence[str]], predicted: Sequence[Sequence[str]]) -> int:
    """Words of the reference's sentences in a common subsequence with any predicted sentence.

    A sentence's places are united over all predicted sentences; a word counts at most as often as the whole
    prediction holds it. So a pair of sentences is compared only while it may cover a place of a word that is
    covered less often than the prediction holds it; sentences at the same place come first.
    """
    left = Counter(word for sentence in predicted for word in sentence)  # held and not yet covered
    covered = [set() for _ in reference]

    def cover(n: int, places: Sequence[int]) -> None:
        for place in places:
            if place not in covered[n]:
                covered[n].add(place)
                left[reference[n][place]] -= 1

    for n, (sentence, other) in enumerate(zip(reference, predicted)):
        places = embedded_places(sentence, other)
        cover(n, lcs_places(sentence, other) if places is None else places)

    others, holders = [], {}  # those that hold a word
    if any(left[word] > 0 for sentence in reference for word in sentence):
        others = [(s, places_of(s)) for s in dict.fromkeys(map(tuple, predicted))]  # equal lines give equal places
        for k, (_, where) in enumerate(others):
            for word in where:
                holders.setdefault(word, []).append(k)
    for n, sentence in enumerate(reference if others else ()):
        wanted = {p: w for p, w in enumerate(sentence) if p not in covered[n] and left[w] > 0}
        # Those with the most wanted words first: what they cover leaves less to look for in the rest.
        near = Counter(k for word in wanted.values() for k in holders.get(word, ()))
        for k, _ in near.most_common():
            other, where = others[k]
            if any(w in where and p not in covered[n] and left[w] > 0 for p, w in wanted.items()):
                shared = [p for p, w in enumerate(sentence) if w in where]  # words that the other lacks change nothing
                cover(n, [shared[p] for p in lcs_places([sentence[p] for p in shared], other, where)])
    return sum(map(len, predicted)) - sum(rest for rest in left.values() if rest > 0)


def indel_ratio(a: str, b: str) -> float:
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


PLACES_AT_ONCE = 1 << 16  # letters of both sides of the pairs that go through the grid together


def _window_lcs(pairs: Sequence[tuple[str, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each pair (a, b): LCS of `a` with every window of `b` as long as `a`, and with every shorter prefix.

    One pass over the grid, diagonal by diagonal, gives the lengths for all
    substrings of `b` at once (Alves et al. 2008), for all pairs together.
    Windows cut off by the end of `b` are included. Shorter strings are filled
    with letters that match nothing: such a row changes no strand, and such a
    column lies behind all others.
    """
    m, n = max(len(a) for a, _ in pairs), max(len(b) for _, b in pairs)
    _, code = np.unique(np.array([ord(ch) for a, b in pairs for ch in a + b]), return_inverse=True)
    kind = np.int16 if max(n, len(code)) < 1 << 15 else np.int32
    left, right = np.full((m, len(pairs)), -1, kind), np.full((n, len(pairs)), -2, kind)
    at = 0
    for k, (a, b) in enumerate(pairs):
        left[m - len(a) :, k] = code[at : at + len(a)][::-1]
        right[: len(b), k] = code[at + len(a) : at + len(a) + len(b)]
        at += len(a) + len(b)
    down = np.repeat(np.arange(1, n + 1, dtype=kind)[:, None], len(pairs), axis=1)
    across = np.zeros((m, len(pairs)), dtype=kind)
    for d in range(m + n - 1):
        lo, hi = max(0, d - m + 1), min(n, d + 1)
        shift = m - 1 - d
        v, h = across[lo + shift : hi + shift], down[lo:hi]
        change = (left[lo + shift : hi + shift] == right[lo:hi]) | (v > h)  # the strands change places
        moved = (v ^ h) * change
        v ^= moved
        h ^= moved
    for k, (a, b) in enumerate(pairs):
        m, n = len(a), len(b)
        mine, end = down[:n, k].astype(np.int64), np.arange(1, n + 1)
        # letter `end` counts in every window that reaches it and starts after mine[end]
        begin = np.maximum(np.maximum(mine + 1, end - m + 1), 1)
        used = begin <= end
        step = np.bincount(begin[used], minlength=n + 2) - np.bincount(end[used] + 1, minlength=n + 2)
        yield np.cumsum(step)[1 : n + 1], np.cumsum(mine[: m - 1] == 0)


def best_windows(pairs: Sequence[tuple[str, str]]) -> list[float]:
    """For each pair the best ratio of the shorter string with any window of the longer one.

    Windows have the shorter string's length; those over either end are shorter.
    Pairs of like lengths are scored together.
    """
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    scores = [0.0 if b else 100.0 for _, b in pairs]
    order = sorted((k for k, (a, _) in enumerate(pairs) if a), key=lambda k: (len(pairs[k][1]), len(pairs[k][0])), reverse=True)
    while order:
        a, b = pairs[order[0]]
        some = max(1, PLACES_AT_ONCE // (len(a) + len(b)))
        now, order = order[:some], order[some:]
        for k, (common, prefixes) in zip(now, _window_lcs([pairs[k] for k in now])):
            m, n = map(len, pairs[k])
            best = 200.0 * common / (m + np.minimum(m, n - np.arange(n)))
            head = 200.0 * prefixes / (m + np.arange(1, len(prefixes) + 1))
            scores[k] = float(max(best.max(), head.max(initial=0.0)))
    return scores


def best_window(a: str, b: str) -> float:
    return best_windows([(a, b)])[0]


def _set_parts(a: str, b: str) -> tuple[str, str, str]:
    left, right = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(part)) for part in (left & right, left - right, right - left))


def _token_sort(a: str, b: str, score=indel_ratio) -> float:
    return score(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str, score=indel_ratio) -> float:
    """Compare the shared words, and the shared words with each side's own words."""
    common, left, right = _set_parts(a, b)
    if not (common or left) or not (common or right):
        return 0.0
    if common and not (left and right):
        return 100.0
    if common and score is best_window:
        return 100.0
    full_left, full_right = f"{common} {left}".strip(), f"{common} {right}".strip()
    scores = [score(full_left, full_right)]
    if common:
        scores += [score(common, full_left), score(common, full_right)]
    return max(scores)


def _prepared(text: str) -> str:
    """Lower case; anything but letters and digits becomes a blank."""
    return "".join(ch if ch.isalnum() else " " for ch in text.lower()).strip()


def quick(a: str, b: str) -> float:
    a, b = _prepared(a), _prepared(b)
    return indel_ratio(a, b) if a and b else 0.0


# Weights of the combined score.
WORD_WEIGHT, LONG_WEIGHT, VERY_LONG_WEIGHT = 0.95, 0.9, 0.6


def weighted_scores(pairs: Sequence[tuple[str, str]]) -> list[float]:
    """For each pair the best of the plain, word-order and window scores, scaled by how unlike the lengths are."""
    scores, asked = [], []  # asked: (pair, weight, a, b) for `best_windows`
    for k, (a, b) in enumerate((_prepared(a), _prepared(b)) for a, b in pairs):
        if not a or not b:
            scores.append(0.0)
            continue
        longer = max(len(a), len(b)) / min(len(a), len(b))
        scores.append(indel_ratio(a, b))
        if longer < 1.5:
            scores[k] = max(scores[k], *[WORD_WEIGHT * s for s in (_token_sort(a, b), token_set(a, b))])
            continue
        scale = LONG_WEIGHT if longer < 8 else VERY_LONG_WEIGHT
        asked.append((k, scale, a, b))
        _token_sort(a, b, lambda *sides: asked.append((k, WORD_WEIGHT * scale, *sides)))
        common, left, right = _set_parts(a, b)
        if common:
            scores[k] = max(scores[k], WORD_WEIGHT * scale * 100.0)
        elif left and right:
            asked.append((k, WORD_WEIGHT * scale, left, right))
    for (k, weight, _, _), found in zip(asked, best_windows([sides for _, _, *sides in asked])):
        scores[k] = max(scores[k], weight * found)
    return scores


def weighted(a: str, b: str) -> float:
    return weighted_scores([(a, b)])[0]


def _jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, hits = bytearray(len(b)), []
    for i, ch in enumerate(a):
        j = b.find(ch, max(0, i - reach), i + reach + 1)
        while j >= 0 and taken[j]:
            j = b.find(ch, j + 1, i + reach + 1)
        if j >= 0:
            taken[j] = 1
            hits.append(ch)
    if not hits:
        return 0.0
    other = [ch for ch, t in zip(b, taken) if t]
    swaps = sum(x != y for x, y in zip(hits, other)) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def winkler(a: str, b: str) -> float:
    score = _jaro(a, b)
    shared = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        shared += 1
    return 100.0 * (score + shared * 0.1 * (1 - score) if score > 0.7 else score)


def _pair_udf(score):
    @F.pandas_udf(T.DoubleType())
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(left, right)], dtype="float64")

    return run


def _pairs_udf(scores):
    """Like `_pair_udf`, for a function of all pairs of a batch."""

    @F.pandas_udf(T.DoubleType())
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        both = [(x, y) for x, y in zip(left, right) if x is not None and y is not None]
        found = iter(scores(both))
        return pd.Series([None if x is None or y is None else next(found) for x, y in zip(left, right)], dtype="float64")

    return run


ratio = _pair_udf(indel_ratio)
partial_ratio = _pairs_udf(best_windows)
token_set_ratio = _pair_udf(token_set)
weighted_ratio = _pairs_udf(weighted_scores)
q_ratio = _pair_udf(quick)
jaro_winkler = _pair_udf(winkler)


@F.pandas_udf(T.IntegerType())
def word_lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    """Common subsequence of two word arrays."""
    return pd.Series([lcs_length(list(x), list(y)) for x, y in zip(left, right)])


@F.pandas_udf(T.LongType())
def sentence_hits(reference: pd.Series, predicted: pd.Series) -> pd.Series:
    """`union_hits` of two arrays of sentences, each an array of words; null is no sentence."""
    lists = lambda x: [] if x is None else [list(s) for s in x]
    return pd.Series([union_hits(lists(x), lists(y)) for x, y in zip(reference, predicted)], dtype="int64")


def hamming(a: Column, b: Column) -> Column:
    """Number of differing places; null for unlike lengths."""
    places = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("bigint"))
    return F.when(F.length(a) == F.length(b), F.aggregate(places, F.lit(0).cast("bigint"), lambda n, x: n + x))
