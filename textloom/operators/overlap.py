"""Overlap of texts with a reference set, such as training texts with a benchmark.

The runs of `window` words of the reference set are hashed into a Bloom filter:
each map task sets bits in bitmaps, and the bitmaps are combined by `or`. Its
size follows the number of runs up to `MOST_BITS`, a bound whatever the size of
the reference set; a fuller filter lets more candidates through, no result
changes. The texts are read once against it, and only the runs it lets through
leave their task, as text, for an exact join with the runs of the reference set.

Null and empty texts, and texts of fewer than `window` words, have no runs. A
run that a text repeats counts each time. Ids are unique and not null. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.arrays import cuts
from textloom.sources.scratch import durable

WORDS_AT_ONCE = 200_000
MOST_BITS = 1 << 27
BITS_PER_RUN = 16
_PAGE = 1 << 15  # bits of one bitmap of Spark's bitmap functions
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # odd numbers that spread a hash over the bits


def run_hashes(words: pa.Array, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the run that starts at each word and whether the run stays inside its text, for texts laid end to end."""
    import xxhash

    coded = pc.dictionary_encode(words)
    of_word = np.array([xxhash.xxh64_intdigest(w.as_py().encode()) for w in coded.dictionary], dtype=np.uint64)
    codes = of_word[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)
    hashes, n = np.zeros(len(codes), dtype=np.uint64), len(codes) - window + 1
    with np.errstate(over="ignore"):
        for j in range(window if n > 0 else 0):
            hashes[:n] = hashes[:n] * np.uint64(_FACTORS[0]) + codes[j : j + n]
    ends = np.repeat(np.cumsum(sizes), sizes)
    return hashes, np.arange(len(codes)) + window <= ends


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a filter of `bits` (a power of two), one column for each factor."""
    shift = np.uint64(64 - bits.bit_length() + 1)
    with np.errstate(over="ignore"):
        return np.stack([((hashes * np.uint64(f)) >> shift).astype(np.int64) for f in _FACTORS], axis=1)


def _runs(df: DataFrame, key: str, words: Column, window: int, bits: int, filter_bits=None) -> DataFrame:
    """`(key, n_runs, run, n, places)`: the runs of each text, or those the filter lets through; a row without run for each text."""
    schema = "id long, n_runs long, run string, n long, places array<long>"
    names = ("id", "n_runs", "run", "n", "places")
    types = pa.schema([(c, t) for c, t in zip(names, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if filter_bits is None else filter_bits.value
        for batch in batches:
            of_batch = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, stop in cuts(of_batch, WORDS_AT_ONCE):
                part, sizes = batch.slice(start, stop - start), of_batch[start:stop]
                ids, flat = part.column(0).to_pylist(), part.column(1).flatten()
                hashes, whole = run_hashes(flat, sizes, window)
                places = bit_places(hashes, bits)
                if held is not None:
                    whole &= np.all((held[places >> 3] >> (places & 7).astype(np.uint8)) & 1, axis=1)
                text = np.repeat(np.arange(len(sizes)), sizes)
                rows: dict[tuple[int, str], list] = {}
                for at in np.flatnonzero(whole).tolist():
                    found = " ".join(flat.slice(at, window).to_pylist())
                    rows.setdefault((int(text[at]), found), [0, at])[0] += 1
                n_runs = np.maximum(0, sizes - window + 1).tolist()
                out = [(ids[i], n_runs[i], None, 0, None) for i in range(len(ids))] if held is not None else []
                out += [(ids[i], None, found, n, places[at].tolist() if held is None else None) for (i, found), (n, at) in rows.items()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), types)], schema=types)

    return df.select(F.col(key).cast("long").alias("id"), words.alias("words")).mapInArrow(run, schema)


def bloom_filter(places: DataFrame, bits: int) -> np.ndarray:
    """The filter of `places(place)` as bytes: bitmaps of a fixed size, combined in the map tasks before the shuffle."""
    n = F.col("place") + 1
    pages = places.groupBy(F.bitmap_bucket_number(n).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bitmap"))
    out = np.zeros(max(bits, _PAGE) // 8, dtype=np.uint8)
    for row in pages.collect():  # bits / 8 bytes in all, at most MOST_BITS / 8
        start = (row.page - 1) * (_PAGE // 8)
        out[start : start + _PAGE // 8] = np.frombuffer(row.bitmap, dtype=np.uint8)
    return out


def text_overlap(
    texts: DataFrame, key: str, words: Column, reference: DataFrame, reference_words: Column, window: int = 13, bits: int | None = None
) -> DataFrame:
    """`(key, n_windows, n_found, share)` of the texts that share a run of `window` words with the reference texts."""
    spark = texts.sparkSession
    listed = reference.select(F.lit(0).alias("__id"), reference_words.alias("__words"))
    if bits is None:
        runs = listed.agg(F.sum(F.greatest(F.lit(0), F.coalesce(F.size("__words"), F.lit(0)) - (window - 1)))).first()[0] or 0
        bits = 1 << max(15, min(MOST_BITS, BITS_PER_RUN * runs).bit_length() - 1)
    known = durable(_runs(listed, "__id", F.col("__words"), window, bits).groupBy("run").agg(F.first("places").alias("places")))
    held = spark.sparkContext.broadcast(bloom_filter(known.select(F.explode("places").alias("place")), bits))
    found = durable(_runs(texts, key, words, window, bits, held))
    exact = found.filter("run is not null").join(known.select("run"), "run", "left_semi")
    hits = exact.groupBy("id").agg(F.sum("n").alias("n_found"))
    counted = found.filter("run is null").select("id", F.col("n_runs").alias("n_windows")).join(hits, "id")
    return counted.select(F.col("id").alias(key), "n_windows", "n_found", (F.col("n_found") / F.col("n_windows")).alias("share"))
