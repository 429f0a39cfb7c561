"""Token arrays: framing, padding, windows and length budgets, all row-local."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids of the special tokens and the ignored label.
CLS, SEP, PAD, IGNORE = 101, 102, 0, -100


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once.

    A lambda would otherwise recompute a long expression for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """`(start, stop)` of runs of rows that add up to `most` at most; a larger row is a run of its own."""
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > most:
            yield start, row
            start, held = row, 0
        held += size
    if len(sizes):
        yield start, len(sizes)


def _ints(*values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def framed(ids: Column, max_len: int) -> Column:
    """CLS + ids + SEP, cut to `max_len`."""
    return F.concat(_ints(CLS), F.slice(ids, 1, max_len - 2), _ints(SEP))


def padded(ids: Column, width: Column | int, left: bool = False, fill: int = PAD) -> Column:
    gap = F.greatest(F.lit(width) if isinstance(width, int) else width, F.size(ids)) - F.size(ids)
    blanks = F.array_repeat(F.lit(fill), gap.cast("int"))
    return F.concat(blanks, ids) if left else F.concat(ids, blanks)


def rounded_width(size: Column, multiple: int) -> Column:
    """The next multiple of `multiple`."""
    return (F.ceil(size / multiple) * multiple).cast("int")


def mask(ids: Column, width: Column | int, left: bool = False) -> Column:
    """1 for tokens, 0 for padding."""
    return padded(F.array_repeat(F.lit(1), F.size(ids)), width, left)


def causal_labels(ids: Column, attention: Column) -> Column:
    """A copy of the ids with padding set to -100."""
    return F.zip_with(ids, attention, lambda i, m: F.when(m == 0, F.lit(IGNORE)).otherwise(i))


def pair_ids(first: Column, second: Column) -> Column:
    return F.concat(_ints(CLS), first, _ints(SEP), second, _ints(SEP))


def pair_segments(first: Column, second: Column) -> Column:
    """0 for CLS, the first text and its SEP; 1 for the rest."""
    return F.concat(F.array_repeat(F.lit(0), F.size(first) + 2), F.array_repeat(F.lit(1), F.size(second) + 1))


def windows(ids: Column, size: int, overlap: int = 0) -> Column:
    """Consecutive windows; the last one ends with the last id.

    No window lies wholly inside the one before it.  Empty input gives one empty window.
    """
    step = size - overlap

    def cut(x):
        last = F.ceil(F.greatest(F.lit(0), F.size(x) - size) / step).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(x, i * step + 1, size))

    return let(ids, cut)


def keep_tail(ids: Column, count: int) -> Column:
    return F.when(F.size(ids) > count, F.slice(ids, -count, count)).otherwise(ids)


def keep_head(ids: Column, count: Column | int) -> Column:
    return F.slice(ids, 1, F.lit(count) if isinstance(count, int) else count)
