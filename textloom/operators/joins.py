"""Lookups, set joins, range joins and vector joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from textloom.functions import fuzzy
from textloom.functions.hashing import HASH_SPACE, hash_key
from textloom.functions.vectors import cosine
from textloom.operators.ordering import by_key

RANGE_BUCKET = 256
PAIRS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 1 << 18


def outer_with_blanks(
    left: DataFrame, right: DataFrame, on: Sequence[str], blanks: Sequence[str], fill: str = " "
) -> DataFrame:
    """Full outer join; the listed text columns read `fill` where a side has no row."""
    joined = left.join(right, list(on), "full_outer")
    return joined.withColumns({c: F.coalesce(c, F.lit(fill)) for c in blanks})


def vectors_with_default(vocabulary: DataFrame, vectors: DataFrame, noise_seed: int | None = None) -> DataFrame:
    """Vector of each word; an unknown word gets the mean vector.

    With `noise_seed`, unknown words get mean + deviation * a hash-drawn
    number instead, so that equal words still get equal vectors.
    """
    summary = Summarizer.metrics("mean", "std").summary(array_to_vector("vec")).alias("s")
    stats = vectors.select(summary).select(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("dev")
    ).first()
    joined = vocabulary.join(vectors, "word", "left")
    default = F.lit(list(stats["mean"]))
    if noise_seed is not None:
        places = F.transform(
            F.sequence(F.lit(0), F.lit(len(stats["mean"]) - 1)),
            lambda i: _normal(F.concat(F.col("word"), F.lit("/"), i.cast("string")), noise_seed),
        )
        spread = F.zip_with(F.lit(list(stats["dev"])), places, lambda s, z: s * z)
        default = F.zip_with(F.lit(list(stats["mean"])), spread, lambda m, x: m + x)
    known = F.col("vec").cast("array<double>")
    return joined.select("word", F.coalesce(known, default).alias("vec"), F.col("vec").isNotNull().alias("known"))


def _normal(key: Column, seed: int) -> Column:
    """A standard normal number from two hash keys (Box-Muller)."""
    u = (hash_key(key, seed) + 1) / F.lit(float(HASH_SPACE + 1))
    v = hash_key(key, seed + 1) / F.lit(float(HASH_SPACE))
    return F.sqrt(-2 * F.log(u)) * F.cos(v * (2 * 3.141592653589793))


def attach_spans(docs: DataFrame, spans: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Span rows with their own words, from `docs(key, words)` and `spans(key, k, class, start_word, end_word)`.

    The spans of one text travel as one array, so the text is joined once and
    not copied for every span.
    """
    bundled = spans.groupBy(key).agg(F.collect_list(F.struct("k", "class", "start_word", "end_word")).alias("spans"))

    def cut(s):
        size = (s["end_word"] - s["start_word"] + 1).cast("int")
        text = F.array_join(F.slice(F.col("words"), (s["start_word"] + 1).cast("int"), size), " ")
        return F.struct(s["k"].alias("k"), s["class"].alias("class"), text.alias("discourse_text"))

    joined = docs.join(bundled, key)
    return joined.select(key, *keep, F.explode(F.transform("spans", cut)).alias("s")).select(key, *keep, "s.*")


def bundled(df: DataFrame, key: str, name: str, parts: int | None = None, gather=F.collect_list) -> DataFrame:
    """`(key, name)`: the other columns of a key's rows as equally long arrays, fields of the struct `name`.

    `gather` may be `collect_set`, for different rows only. `parts` is as in `ordering.by_key`. Rows without a key meet nothing and do not become one array.
    """
    fields = [c for c in df.columns if c != key]
    rows = df if parts is None else by_key(df, [key], parts)
    apart = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*fields), F.lit(4096))).alias("__apart")
    grouped = rows.groupBy(key, apart).agg(gather(F.struct(*fields)).alias("__rows"))
    return grouped.select(key, F.struct(*[F.col(f"__rows.`{c}`").alias(c) for c in fields]).alias(name))


def arrow_lists(function: Callable[..., pa.Array], kind: ArrayType) -> Callable[..., Column]:
    """A function of Arrow lists, evaluated once a row: what is not deterministic is not copied to where it is used."""
    return F.arrow_udf(function, kind).asNondeterministic()


def list_values(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of values of each list, all values as whole numbers, and which of them are not null."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    known = values.is_valid().to_numpy(zero_copy_only=False)
    return sizes, pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64), known


def _ranks(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Both from 0 on, in one order: by their distance to the least, or by rank where that is `most` or more."""
    least = min(x.min(initial=np.iinfo(np.int64).max) for x in (a, b))
    if max(int(x.max(initial=least)) for x in (a, b)) - int(least) < most:
        return a - least, b - least
    _, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    return place[: len(a)], place[len(a) :]


def places_inside(
    p_text: np.ndarray, p_start: np.ndarray, p_end: np.ndarray, s_text: np.ndarray, s_start: np.ndarray, s_end: np.ndarray, bucket: int
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a point and a span of its text with `s_start <= p_start` and `p_end <= s_end`, by points.

    Spans are listed in every bucket that they reach. In a bucket, in order of their starts, those that a point may lie in
    are between the first one up to which any ends late enough and the last one that starts early enough.
    """
    if not len(p_text) or not len(s_text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low, high = np.minimum(s_start, s_end) // bucket, np.maximum(s_start, s_end) // bucket
    n = high - low + 1
    span = np.repeat(np.arange(len(s_text)), n)
    cell = np.arange(len(span)) - np.repeat(np.cumsum(n) - n - low, n)
    p_cell = p_start // bucket
    begin = np.clip(s_start[span] - cell * bucket, 0, bucket)
    end, p_until = _ranks(np.maximum(s_end[span] - cell * bucket, 0), np.maximum(p_end - p_cell * bucket, 0), 1 << 20)
    cell, p_rank = _ranks(cell, p_cell, 1 << 20)
    width, reach = max(int(cell.max()), int(p_rank.max())) + 1, max(int(end.max()), int(p_until.max())) + 1
    code, p_code = s_text[span] * width + cell, p_text * width + p_rank
    order = np.lexsort((begin, code))
    span, starts = span[order], code[order] * (bucket + 1) + begin[order]
    upto = np.searchsorted(starts, p_code * (bucket + 1) + (p_start - p_cell * bucket), "right")
    latest = np.maximum.accumulate(code[order] * reach + end[order])
    since = np.searchsorted(latest, p_code * reach + p_until, "left")
    many = np.maximum(upto - since, 0)
    points, spans, total, done = [], [], np.cumsum(many), 0
    while done < len(many):  # a bounded number of candidates at a time
        more = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS_AT_ONCE, "right")))
        m = many[done:more]
        point = np.repeat(np.arange(done, more), m)
        near = span[np.arange(len(point)) - np.repeat(np.cumsum(m) - m - since[done:more], m)]
        good = (s_start[near] <= p_start[point]) & (p_end[point] <= s_end[near])
        points.append(point[good])
        spans.append(near[good])
        done = more
    return np.concatenate(points), np.concatenate(spans)


def texts_of(sizes: np.ndarray) -> np.ndarray:
    """The number of the list that each of all values belongs to."""
    return np.repeat(np.arange(len(sizes)), sizes)


def pairs_inside(points: Sequence[pa.ListArray], spans: Sequence[pa.ListArray], bucket: int) -> tuple[np.ndarray, ...]:
    """`places_inside` for `(start, end)` lists of whole texts, and the lists' sizes; a null position is nowhere."""
    sides, sizes = [], []
    for starts, ends in (points, spans):
        (size, start, known), (_, end, closed) = list_values(starts), list_values(ends)
        whole = np.flatnonzero(known & closed)
        sides.append((whole, texts_of(size)[whole], start[whole], end[whole]))
        sizes.append(size)
    (p_whole, *p_side), (s_whole, *s_side) = sides
    found, text, n = [], 0, len(sizes[0])
    work = np.cumsum(sum(np.bincount(side[0], minlength=n) for side in (p_side, s_side)))
    while text < n:  # as many texts as have a bounded number of points and spans, one at least
        more = max(text + 1, int(np.searchsorted(work, (work[text - 1] if text else 0) + ROWS_AT_ONCE, "right")))
        (p_from, p_to), (s_from, s_to) = (np.searchsorted(side[0], (text, more)) for side in (p_side, s_side))
        point, span = places_inside(*(x[p_from:p_to] for x in p_side), *(x[s_from:s_to] for x in s_side), bucket)
        found.append((p_whole[point + p_from], s_whole[span + s_from]))
        text = more
    point, span = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else 2 * [np.empty(0, np.int64)]
    return point, span, *sizes


def list_array(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def inside(points: Column, spans: Column, bucket: int = RANGE_BUCKET) -> Column:
    """For each of a text's `points` (arrays `tok_start`, `tok_end`) the places of those `spans` (`span_start`, `span_end`) that hold it."""

    def found(tok_start: pa.Array, tok_end: pa.Array, span_start: pa.Array, span_end: pa.Array) -> pa.Array:
        point, span, p_sizes, s_sizes = pairs_inside((tok_start, tok_end), (span_start, span_end), bucket)
        before = np.cumsum(s_sizes) - s_sizes
        place = span - before[texts_of(p_sizes)[point]]
        hits = list_array(np.bincount(point, minlength=p_sizes.sum()), pa.array(place, pa.int32()))
        return list_array(p_sizes, hits)

    places = arrow_lists(found, ArrayType(ArrayType(IntegerType())))
    return places(*[side[c].cast("array<bigint>") for side, c in ((points, "tok_start"), (points, "tok_end"), (spans, "span_start"), (spans, "span_end"))])


def together(
    points: DataFrame | Column, spans: DataFrame | Column, key: str, how: str, parts: int | None, rows: DataFrame | None, gather=F.collect_list
) -> DataFrame:
    """`(key, __p, __s)`: the points and the spans of a text as structs of arrays, from two tables or from `rows`; a null key meets nothing."""
    if rows is not None:
        return rows.select(key, points.alias("__p"), F.when(F.col(key).isNotNull(), spans).alias("__s"))
    return bundled(points, key, "__p", parts, gather).join(bundled(spans, key, "__s", parts), key, how)


def contained(
    points: DataFrame | Column, spans: DataFrame | Column, key: str, how: str = "inner", bucket: int = RANGE_BUCKET,
    parts: int | None = None, rows: DataFrame | None = None,
) -> DataFrame:
    """Rows of `points(key, tok_start, tok_end)` inside `spans(key, span_start, span_end)`; `how="left"` keeps lone points once.

    The points and the spans of a key meet as arrays; inside a text both are cut into buckets of `bucket` characters, so
    only near pairs are compared. Both sides have `parts` partitions, if given, which bounds what a task holds. With
    `rows`, a row a text, points and spans are structs of arrays there and nothing is shuffled.
    """
    both = together(points, spans, key, how, parts, rows)
    of_point, of_span = (both.schema[c].dataType.names for c in ("__p", "__s"))
    found = both.withColumn("__found", inside(F.col("__p"), F.col("__s"), bucket))
    one = found.select(key, "__p", "__s", F.posexplode("__found").alias("__i", "__hits"))
    met = one.select(key, "__p", "__s", "__i", (F.explode if how == "inner" else F.explode_outer)("__hits").alias("__j"))
    return met.select(
        key,
        *[F.get(F.col(f"__p.`{c}`"), F.col("__i")).alias(c) for c in of_point],
        *[F.get(F.col(f"__s.`{c}`"), F.col("__j")).alias(c) for c in of_span],
    )


def similarity_to(df: DataFrame, vector: str, query: Sequence[float]) -> DataFrame:
    """Cosine of every row's vector with one query vector."""
    return df.withColumn("cosine", cosine(F.col(vector), F.lit([float(x) for x in query])))


def scored_join(left: DataFrame, right: DataFrame, on: Sequence[str], a: str, b: str) -> DataFrame:
    """Strings of two tables that share a key, with their similarity scores.

    The key is the block: `right` holds one string per key (a reference list),
    so every left row is scored once.
    """
    pairs = left.join(right, list(on))
    return pairs.withColumns(
        {"ratio": fuzzy.ratio(a, b), "jaro_winkler": fuzzy.jaro_winkler(a, b), "distance": fuzzy.hamming(F.col(a), F.col(b))}
    )


def fold_ensemble(scores: DataFrame, key: str, columns: Sequence[str], folds: int, digits: int = 1) -> DataFrame:
    """Sum of score / folds over the folds, rounded."""
    sums = [F.round(F.sum(F.col(c) / folds), digits).alias(c) for c in columns]
    return scores.groupBy(key).agg(*sums)


def frequent_keys(rows: DataFrame, key: str, parts: int = 200) -> list:
    """Keys that may hold more than one row in `parts`: fewer than `2 * parts` of them, from one sketch a task.

    A frequency sketch decides, so its errors change which keys are salted, never a result.
    """
    sketch = F.expr(f"approx_top_k({key}, {2 * parts}, {100 * parts})")
    found = rows.agg(sketch.alias("top"), F.count(key).alias("n")).first()
    return [r.item for r in found.top or () if r.item is not None and r["count"] * parts > found.n]


def salted_lookup(
    rows: DataFrame, mapping: DataFrame, key: str, spread: Sequence[str], how: str = "left", heavy: Sequence | None = None,
    salts: int = 32, parts: int | None = None,
) -> DataFrame:
    """`rows.join(mapping, key, how)` where a key may hold a third of all rows; `how` is left or inner.

    Rows of a heavy key are dealt over `salts` tasks by a hash of the `spread` columns, so a repeated task deals them
    alike, and the mapping's rows of that key are repeated `salts` times; all other rows are untouched. Without `heavy`
    the rows are read once more for `frequent_keys`. A null key matches nothing, as in any join, and is dealt like a heavy one.
    Both sides have `parts` partitions, if given, which bounds what a task sorts.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a salted lookup is left or inner, not {how}")
    heavy = frequent_keys(rows, key) if heavy is None else list(heavy)
    hot = F.col(key).isin(heavy)
    place = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = rows.withColumn("__salt", F.when(hot | F.col(key).isNull(), place).otherwise(0))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    listed = mapping.withColumn("__salt", F.explode(copies))
    if parts is not None:
        salted, listed = by_key(salted, [key, "__salt"], parts), by_key(listed, [key, "__salt"], parts)
    return salted.join(listed, [key, "__salt"], how).drop("__salt")
