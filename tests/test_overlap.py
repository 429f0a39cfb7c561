"""Overlap of texts with a reference set against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions.text import words
from textloom.operators import overlap


def _plain(texts, reference, window):
    runs = lambda t: [tuple((t or "").split()[i : i + window]) for i in range(len((t or "").split()) - window + 1)]
    known = {run for t in reference for run in runs(t)}
    found = {i: (len(runs(t)), sum(run in known for run in runs(t))) for i, t in texts}
    return {i: pair for i, pair in found.items() if pair[1]}


@pytest.mark.parametrize("bits", [None, 1 << 15])
def test_equals_the_plain_version(spark, bits):
    rng = np.random.default_rng(7)
    reference = [" ".join(rng.choice(list("abcd"), n)) for n in (0, 2, 3, 40, 80)] + [None, "é é é é", "x " * 50]
    texts = [(i, " ".join(rng.choice(list("abcdef"), int(rng.integers(0, 60))))) for i in range(200)]
    texts += [(300, None), (301, ""), (302, "x"), (303, "x " * 5000), (304, "é é é é é"), (305, "b c")]
    df = spark.createDataFrame(texts, "id long, text string").withColumn("run", F.lit("clash")).withColumn("words", F.lit(1)).repartition(5)
    bench = spark.createDataFrame([(t,) for t in reference], "text string")
    got = overlap.text_overlap(df, "id", words(F.col("text")), bench, words(F.col("text")), window=4, bits=bits)
    rows = {r.id: (r.n_windows, r.n_found, r.share) for r in got.collect()}
    want = _plain(texts, reference, 4)
    assert rows == {i: (n, k, k / n) for i, (n, k) in want.items()} and len(want) > 20
    for a, b in ((df.filter("id < 0"), bench), (df, bench.filter("text = '?'"))):
        assert overlap.text_overlap(a, "id", words(F.col("text")), b, words(F.col("text")), window=4).count() == 0


def test_the_filter_holds_its_places_and_little_else(spark):
    places = np.random.default_rng(8).integers(0, 1 << 17, 500)
    table = spark.createDataFrame([(int(p),) for p in places], "place long")
    held = np.unpackbits(overlap.bloom_filter(table, 1 << 17), bitorder="little")
    assert set(np.flatnonzero(held).tolist()) == set(places.tolist())


def test_a_batch_of_many_words_goes_in_parts(spark, monkeypatch):
    """Texts of 250,000 words in one batch: runs inside a text are found, none across the border of two parts."""
    import pyarrow as pa

    from textloom.operators import overlap

    seen, whole = [], overlap.run_hashes
    monkeypatch.setattr(overlap, "run_hashes", lambda words, sizes, window: seen.append(len(words)) or whole(words, sizes, window))
    texts = [[f"w{k}x{i % 500}" for i in range(10_000)] for k in range(25)]
    made = {}

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(range(25), pa.int64()), pa.array(texts)], names=["id", "words"])
            made["rows"] = [r for b in run(iter([batch])) for r in b.to_pylist()]

    overlap._runs(Frame(), "id", F.col("words"), 13, 1 << 15)
    assert max(seen) <= 200_000 and sum(seen) == 250_000
    assert sum(r["n"] for r in made["rows"]) == 25 * (10_000 - 12) and len({(r["id"], r["run"]) for r in made["rows"]}) == 25 * 500
