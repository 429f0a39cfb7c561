"""Every operator against a plain version, on the smallest tables and on odd rows."""

import json
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from textloom.llm import mixing, neighbours, packing, quality, secret_scan, simhash, substring, suffix, tokenfile, toxicity
from textloom.llm.common import components, word_count
from textloom.llm.queries import QUERIES, tokenizer_path
from textloom.sources.scratch import new_path

PASSAGE = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (4, "one", "b"), (5, PASSAGE, "b"), (6, "x " + PASSAGE, "b"),
    (7, PASSAGE, None), (8, "ab" * 400, "c"), (9, "é" * 300 + " " + "é" * 300, "c"), (10, PASSAGE + " tail " + PASSAGE, "c"),
    (11, "Password: abcdefghijklmn token='short' AKIA" + "A1" * 9 + " " + "0123456789abcdef" * 2, "c"),
    (12, "a  b\n\nc\n\n\nd 　e <|endoftext|> f. g,", "c"), (13, "line | nav | bar | end\nfine text here.", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in ODD]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumn("id", F.lit("clash")).withColumn("size", F.lit(-1))


@pytest.fixture(scope="module")
def all_rows(tables):
    return [(r.doc_id, r.text) for r in tables.documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["table", "odd"])
def case(request, tables, docs, all_rows):
    return (tables.documents, all_rows) if request.param == "table" else (docs, [(i, t) for i, t, _ in ODD])


def test_simhash(case):
    df, rows = case
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_classes(df).collect()}
    assert got == brute.simhash(rows)


def test_near_duplicates_keep_the_smallest_id_of_a_group(docs):
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs.filter("doc_id in (4, 5, 6, 7, 8)")).collect()}
    assert kept == {4, 5, 8}


def test_forest_connects_what_all_pairs_connect():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (5, 8), dtype=np.uint8).repeat(20, axis=0)
    base[np.arange(100), rng.integers(0, 8, 100)] ^= np.uint8(1) << rng.integers(0, 8, 100).astype(np.uint8)
    far = [(i, j) for i in range(100) for j in range(i) if np.bitwise_count(base[i] ^ base[j]).sum() <= 3]
    assert brute.components(far) == brute.components(list(simhash.forest(base, 3, 5)))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).df.collect()}
    assert got == {k: v for k, v in brute.components(edges).items() if k in got} and set(range(41)) <= got.keys()


def test_secrets(case):
    df, rows = case
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.secret_spans(df).collect()}
    assert got == {d: brute.secrets(t or "") for d, t in rows}


def test_checksums_decide():
    body = "A" * 30
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = secret_scan.BASE62[digit] + digits
    good = "ghp_" + body + digits.rjust(6, "0")
    kinds = lambda t: {secret_scan.KINDS[k] for _, k, _ in secret_scan.scan(t)}
    assert "github" in kinds(f"x {good} y") and "github" not in kinds(f"x {good[:-1]}{'0' if good[-1] != '0' else '1'} y")
    assert good not in secret_scan.mask_spans(f"x {good} y", secret_scan.scan(f"x {good} y"), "[S]")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    return found


def test_packing(case, tokenizer):
    df, rows = case
    got = packing.best_fit_sequences(df, tokenizer_path(), capacity=64, pieces_per_part=100).collect()
    want = {(d, k): (a, len(ids), brute.crc(ids)) for d, t in rows for k, a, ids in brute.pieces(brute.token_ids(tokenizer, t), 64)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 64 and len(sequences) <= 1.05 * sum(sequences.values()) / 64 + 2


def test_lower_bound_is_met_by_half_sized_pieces():
    import numpy as np

    lengths = np.array([51] * 10 + [30] * 3)
    assert packing.lower_bound(lengths, 100) == 10 == packing.best_fit_decreasing(lengths, 100).max() + 1


def test_token_files(spark, case, tokenizer):
    df, rows = case
    files = tokenfile.write_token_files(df, new_path(spark, "tokens"), tokenizer_path(), 3, frame_ids=500)
    start, want = 0, {}
    for d, t in sorted(rows):
        ids = brute.token_ids(tokenizer, t)
        want[d] = (start, len(ids), brute.crc(ids))
        start += len(ids)
    read = tokenfile.with_starts(tokenfile.read_token_files(spark, files.df), files.df)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read.collect()} == want
    some = tokenfile.read_token_files(spark, files.df, wanted=[rows[3][0]]).collect()
    assert [r.doc_id for r in some] == [rows[3][0]]


def test_substring(case):
    df, rows = case
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.without_repeats(df).collect()}
    assert got == brute.substring(rows)


def test_suffix(case):
    df, rows = case
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.without_repeated_bytes(df).collect()}
    assert got == dict(zip([d for d, _ in rows], brute.suffix(rows)))


def test_suffix_with_many_stretches(spark, monkeypatch):
    """Suffixes with more stretches than are compared together are cut into parts by the hash of a window."""
    monkeypatch.setattr(suffix, "TOGETHER", 2)
    rows = [(i, f"{i * 7919:05d}" * (i % 9) + PASSAGE[i : 260 + 7 * i] + f"{i * 104729:07d}" * (i % 7)) for i in range(24)]
    rows += [(100, rows[3][1]), (101, rows[3][1] + "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.without_repeated_bytes(df).collect()}
    assert got == dict(zip([d for d, _ in rows], brute.suffix(rows)))


def test_quality(case):
    df, rows = case
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    for d, t in rows:
        r = got[d]
        assert brute.quality(t) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.base_failed and r.kept)


def test_mixing(docs, tables):
    for df in (docs, tables.documents):
        rows = mixing.mix(df.drop("size"), word_count(F.col("text"))).collect()
        sizes, taken = Counter(), Counter()
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r.size
        want = brute.targets(sizes)
        assert all(r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] for r in rows)
        assert all(abs(taken[s] - want[s]) < 1.01 for s in sizes)
        mixed = mixing.mixed_documents(df.drop("size")).select(word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
        assert mixed == sum(taken.values())


def test_neighbours(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in tables.embeddings.collect()]
    want = brute.neighbours(rows)
    got = QUERIES["op8_neighbours"](spark, SF).collect()
    assert Counter(r.query_id for r in got) == {q: 10 for q in want}
    assert sum(r.vec_id in dict(want[r.query_id]) for r in got) >= 0.9 * len(got)


def test_neighbours_of_odd_vectors(spark):
    bad = [None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [1.0], [float("inf"), 0.0]]
    good = [[float(i), 1.0] for i in range(6)] + [[0.0, 1.0]]
    vectors = spark.createDataFrame(list(enumerate(good + bad)), "id long, vec array<double>")
    got = neighbours.nearest(vectors, vectors.filter("id = 0"), k=10).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(6, 0.0), *[(i, float(i)) for i in range(1, 6)]]


def test_toxicity(spark, tables):
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert len(got) == tables.documents.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for d, r in got.items())


def test_toxicity_finds_insults_in_rows_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in QUERIES["op2_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in got)
    assert right / len(got) >= 0.93


def test_empty_tables(spark, docs):
    none = docs.filter("doc_id < 0")
    assert simhash.simhash_classes(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0
    assert secret_scan.secret_spans(none).count() == 0 and quality.quality_rules(none).count() == 0
    assert substring.without_repeats(none).count() == 0 and suffix.without_repeated_bytes(none).count() == 0
    assert packing.best_fit_sequences(none, tokenizer_path()).count() == 0
    assert tokenfile.token_file_round_trip(none, tokenizer_path(), 2).count() == 0
    assert mixing.mix(none.drop("size"), word_count(F.col("text"))).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(none, labels).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secrets", "mixing", "packing"]
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and json.loads(rows.schema.json())["fields"][0]["name"] == "doc_id"


def _near_copies(spark):
    """Groups of texts whose sets of shingles are about 0.8 alike, some a little more and some a little less; the texts
    of a group share a long passage with those of the other groups."""
    import random

    rng, texts = random.Random(5), []
    shared = [f"shared{k}" for k in range(30)]
    for group in range(60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 9, 30, 60, 200]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.choice([1, 1, max(1, len(base) // 50), max(1, len(base) // 40)])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts.append(copy + (shared if group % 3 == 0 else []))
    rng.shuffle(texts)
    return list(enumerate(" ".join(t) for t in texts))


def _kept_by_all_pairs(rows, similarity=0.8):
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in ((d, t.split()) for d, t in rows)}
    alike = lambda a, b: len(a & b) >= similarity * len(a | b)
    pairs = [(d, e) for d, _ in rows for e, _ in rows if d < e and alike(sets[d], sets[e])]
    return {d for d, _ in rows} - {max(d, e) for d, e in pairs} - {d for d, root in brute.components(pairs).items() if d != root}


def test_near_duplicates_equal_all_pairs(spark):
    rows = _near_copies(spark)
    got = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _kept_by_all_pairs(rows)


def test_added_tokens_keep_their_ids(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    rows = [(0, "a b. c"), (1, "a <|endoftext|> b"), (2, "x<|endoftext|>\ny, a b."), (3, "<|endoftext|>"), (4, "<|endoftext| b")]
    want = {d: brute.token_ids(plain, t) for d, t in rows}
    assert want[1][:4] == [64, 220, 50256, 275]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    files = tokenfile.write_token_files(df, new_path(spark, "tokens"), tokenizer_path(), 2, frame_ids=500)
    read = tokenfile.with_starts(tokenfile.read_token_files(spark, files.df), files.df)
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in read.collect()} == {d: (len(i), brute.crc(i)) for d, i in want.items()}
    placed = packing.best_fit_sequences(df, tokenizer_path(), capacity=64).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in placed} == {d: (len(i), brute.crc(i)) for d, i in want.items()}


@pytest.mark.parametrize("groups, radius, hot", [(20, 0.02, 0), (20, 0.3, 0), (1, 0.05, 0.34)])
def test_neighbours_in_dense_groups(spark, groups, radius, hot):
    import numpy as np

    rng, n = np.random.default_rng(1), 6000
    centres = rng.normal(size=(groups, 64))
    vectors = centres[rng.integers(0, groups, n)] + radius * rng.normal(size=(n, 64))
    if hot:
        vectors[rng.random(n) >= hot] = 0
        vectors += (vectors == 0).all(axis=1)[:, None] * rng.normal(size=(n, 64))
    table = spark.createDataFrame(list(enumerate(vectors.tolist())), "id long, vec array<double>").repartition(8).cache()
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(table, table.filter("id < 200"), k=10).collect()}
    away = ((vectors[:200, None] - vectors[None]) ** 2).sum(axis=2)
    away[np.arange(200), np.arange(200)] = np.inf
    want = {(i, int(j)) for i, row in enumerate(away) for j in np.argsort(row)[:10]}
    print("recall", len(got & want) / len(want))
    assert len(got & want) >= 0.95 * len(want)
