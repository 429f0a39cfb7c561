"""The Merkle manifest against a plain tree, on a given table and on odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from textloom.llm import manifest
from textloom.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
ODD = [
    (None, None, None, None, None), (None, "b", "en", 1, "Null id"), (5, None, "en", 1, "A"), (5, None, "en", 1, "A"),
    (5, None, "en", 1, "B"), (7, "x", "en", 3, ""), (7, "-", "en", 3, "-"), (0, "é", "fr", None, None),
    (10, "long", "en", 2_000_000, "Very long " * 200_000),
]
MANY = [(i, f"s{i % 40}", "en", i, "Ab" * (i % 50)) for i in range(700)] + [(9, "hot", "en", 1, "SAME")] * 300


def _verified(df):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return manifest.verified_rows(df, tampered, manifest.lower_case(F.col("text")))


@pytest.mark.parametrize("rows", [[], ODD[4:5], ODD, ODD + MANY], ids=["empty", "one", "odd", "many"])
def test_rows_equal_the_plain_tree(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("place", "size", "digest", "children", "path", "presented", "root"):
        df = df.withColumn(name, F.lit("clash"))
    assert Counter(map(tuple, _verified(df).collect())) == Counter(brute.manifest(rows))


def test_documents_equal_the_plain_tree(spark, tables):
    from tests.conftest import SF

    rows = [tuple(r) for r in tables.documents.select(*manifest.FIELDS).collect()]
    got = QUERIES["op13_manifest"](spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == Counter(brute.manifest(rows))


def test_requests_get_the_proofs_of_their_leaves_alone(spark):
    df = spark.createDataFrame(ODD[:8] + MANY, SCHEMA)
    made = manifest.build(df.select("source", "doc_id", manifest.leaf_digest().alias("digest")), [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    every = {(r.source, r.place): (r.digest, r.path) for r in manifest.proofs(made).collect()}
    asked = made.leaves.df.filter("place % 7 = 3 or source is null").select("source", "place")
    some = {(r.source, r.place): (r.digest, r.path) for r in manifest.proofs(made, asked).collect()}
    assert some == {(r.source, r.place): every[r.source, r.place] for r in asked.collect()}
    root = made.root().first().digest
    for digest, path in every.values():
        for level in path:
            digest = brute._hex(level.left + digest + level.right)
        assert digest == root
