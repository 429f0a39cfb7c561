"""Rows that texts are cut into are partitioned by the size of the texts, and blocks of texts by their characters."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from textloom.operators import joins, labels, ordering, splits, tokens


def _texts(spark):
    rows = [(i if i % 9 else None, " ".join(f"w{i * j % 17}" for j in range(1 + i % 40))) for i in range(90)] + [(5, "a b c"), (5, "a b c")]
    return spark.createDataFrame(rows, "doc long, text string").withColumn("words", F.split("text", " "))


def _spans(spark):
    return spark.createDataFrame(
        [(i, 2 * k, 2 * k + 2, "AB"[k % 2]) for i in range(1, 90) for k in range(3)], "doc long, start_word int, end_word int, class string"
    )


def _rows(df):
    return sorted(map(repr, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_follow_the_size(spark):
    df = spark.range(100)
    assert [ordering.parts_for(df, F.lit(n), 1000) for n in (1, 10, 1000)] == [1, 1, 100]
    assert ordering.parts_for(df.filter("id < 0"), F.lit(5)) == 1


def test_tags_keep_their_rows_in_more_parts(spark):
    sizes = _texts(spark).select("doc", F.size("words").alias("n_words"))
    found = labels.bio_tags(sizes, _spans(spark), "doc", parts=7)
    assert _rows(found) == _rows(labels.bio_tags(sizes, _spans(spark), "doc"))
    assert "REPARTITION_BY_NUM" in _plan(found)


def test_points_in_spans_keep_their_rows_in_more_parts(spark):
    points = spark.createDataFrame([(d, 3 * i, 3 * i + 2, i) for d in (1, 2, 2, None) for i in range(300)], "doc long, tok_start long, tok_end long, i int")
    spans = spark.createDataFrame([(d, 20 * k, 20 * k + 30, k) for d in (1, 2, None) for k in range(40)], "doc long, span_start long, span_end long, k int")
    for how in ("inner", "left"):
        few = joins.contained(points, spans, "doc", how)
        assert _rows(joins.contained(points, spans, "doc", how, parts=5)) == _rows(few)


def test_span_targets_shuffle_tokens_to_their_spans_only(spark):
    tokens_ = spark.createDataFrame([(d, 3 * i, 3 * i + 2) for d in (1, 2, None) for i in range(200)], "doc long, tok_start long, tok_end long")
    spans = spark.createDataFrame([(1, 30, 400, "B"), (2, 0, 8, "A"), (2, 299, 320, "B"), (None, 0, 9, "A")], "doc long, span_start long, span_end long, class string")
    found = labels.char_span_targets(tokens_, spans, "doc", ["A", "B"], parts=4)
    got = {(r.doc, r.tok_start): r.target for r in found.collect()}
    want = {(d, 3 * i): 4 for d in (1, 2, None) for i in range(200)}
    want |= {(1, s): 2 + (s > 30) for s in range(30, 399, 3)} | {(2, s): int(s > 0) for s in (0, 3, 6)} | {(2, s): 2 + (s > 300) for s in range(300, 319, 3)}
    assert got == want
    plan = _plan(found)
    assert "Window" not in plan and "hashpartitioning(doc" in plan
    assert "tok_start" not in " ".join(line.split("Exchange")[1] for line in plan.split("\n") if "Exchange hashpartitioning" in line)


def test_encode_and_decode_keep_their_rows_in_more_parts(spark):
    texts = _texts(spark)
    vocabulary = tokens.fit_vocabulary(texts, F.col("words"), 10)
    coded = tokens.encode(texts, "doc", F.col("words"), vocabulary, 10, parts=6)
    assert coded.count() == texts.select("doc").distinct().count()
    unique = texts.filter("doc <> 5 AND doc IS NOT NULL")
    few, many = [
        tokens.decode(tokens.encode(unique, "doc", F.col("words"), vocabulary, 10, p), "doc", F.col("ids"), F.broadcast(vocabulary), p)
        for p in (None, 6)
    ]
    assert _rows(few) == _rows(many)


@pytest.mark.parametrize("name", ["k10_bio_tags", "k8_token_word_map", "k11_span_targets", "j6_tokens_in_spans", "w13_first_prediction", "k2_round_trip", "a13_entity_per_split"])
def test_word_rows_are_not_in_merged_partitions(spark, name):
    assert "REPARTITION_BY_NUM" in _plan(queries()[name](spark, "/root/testdata/sf0.001"))


def test_offset_split_blocks_hold_few_characters(spark, monkeypatch):
    seen = []
    real = splits.prefix_offset
    monkeypatch.setattr(splits, "prefix_offset", lambda *a: seen.append(a[-1]) or real(*a))
    df = spark.createDataFrame([(i, "x" * (100 + i)) for i in range(200)], "id long, text string")
    whole = _rows(splits.offset_split(df, "id", "text", 0.95))
    assert _rows(splits.offset_split(df, "id", "text", 0.95, block_chars=2000)) == whole
    assert seen[-1] <= 2000 / 100
