"""Properties, and comparisons with brute force on skewed data."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import joins, labels, ordering, prompts, splits, tables, texts, tokens
from textloom.operators import statistics as st


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds a third of the rows."""
    rng = np.random.default_rng(0)
    n = 3000
    group = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 400, n))
    pdf = pd.DataFrame({"g": group, "i": rng.permutation(n), "v": rng.integers(1, 50, n)})
    return pdf, spark.createDataFrame(pdf)


def test_running_total_equals_cumsum(skewed):
    pdf, df = skewed
    got = ordering.running_total(
        df, group=["g"], order=[F.col("i")], block=F.floor(F.col("i") / 100), value=F.col("v"), out="t", inclusive=True
    ).toPandas()
    want = pdf.sort_values("i").assign(t=lambda d: d.groupby("g").v.cumsum())
    merged = got.merge(want, on="i")
    assert len(merged) == len(pdf) and (merged.t_x == merged.t_y).all()


def test_hot_group_is_cut_into_blocks(skewed):
    _, df = skewed
    plan = ordering.running_total(
        df, group=["g"], order=[F.col("i")], block=F.floor(F.col("i") / 100), value=F.col("v"), out="t"
    )._jdf.queryExecution().toString()
    assert "windowspecdefinition(g" in plan and "__block" in plan


@pytest.mark.parametrize("rows_per_block", [64, 1_000_000])
def test_dense_index(skewed, rows_per_block):
    pdf, df = skewed
    sparse = df.withColumn("key", F.col("i") * F.col("i"))
    got = ordering.dense_index(sparse, "key", "n", rows_per_block).orderBy("key").toPandas()
    assert (got.n == np.arange(len(pdf))).all()


def test_dense_index_by_strings(skewed):
    pdf, df = skewed
    got = ordering.dense_index_by(df.withColumn("s", F.md5(F.col("i").cast("string"))), [F.col("s")], "n").toPandas()
    assert (got.sort_values("s").n.to_numpy() == np.arange(len(pdf))).all()


def test_prefix_offset_in_many_blocks(skewed):
    pdf, df = skewed
    got = ordering.prefix_offset(df, "i", F.col("v"), "at", 100).toPandas().sort_values("i")
    want = pdf.sort_values("i").v.cumsum().shift(fill_value=0)
    assert (got["at"].to_numpy() == want.to_numpy()).all()


def test_proportional_sample_is_exact(skewed):
    pdf, df = skewed
    shares = {int(g): 0.37 for g in pdf.g.unique()}
    got = splits.proportional_sample(df, "g", "i", shares, 1).groupBy("g").count().toPandas()
    want = (pdf.groupby("g").size() * 0.37).astype(int)
    assert got.set_index("g")["count"].to_dict() == want[want > 0].to_dict()


def test_budget_keeps_the_newest_pairs(spark):
    """One conversation has a third of all pairs and several blocks."""
    rows = [(c, 2 * k, 1 + (k * 7 + c) % 9) for c in range(41) for k in range(400 if c == 0 else 20)]
    df = spark.createDataFrame(rows, "conv_id bigint, pair_turn bigint, tokens bigint")
    got = {(r.conv_id, r.pair_turn) for r in prompts.within_budget(df, 60, block=50).collect()}
    want = set()
    for conv, pairs in itertools.groupby(sorted(rows, key=lambda r: (r[0], -r[1])), key=lambda r: r[0]):
        used = 0
        for _, turn, n in pairs:
            used += n
            if used > 60:
                break
            want.add((conv, turn))
    assert got == want


def test_turn_pairs_skip_greeting_and_open_turns(spark):
    rows = [(1, 0, "assistant", "hi"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2")]
    got = prompts.turn_pairs(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [(r.pair_turn, r.question, r.answer) for r in got] == [(1, "q1", "a1")]


def test_chunks_join_to_the_text(tables):
    rows = tables.documents.select("text", F.array_join(tx.fixed_chunks(F.col("text"), 500), "").alias("back"))
    assert rows.filter("text <> back").count() == 0


def test_packed_blocks_keep_every_token(spark):
    rows = [(i, list(range(1, 1 + (i * 37) % 50))) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, ids array<int>")
    blocks = tokens.pack(df, "id", "ids", 64).orderBy("block").collect()
    stream = [x for _, ids in rows for x in ids + [0]]
    assert [x for b in blocks for x in b.ids] == stream
    assert all(len(b.ids) == 64 for b in blocks[:-1])


def test_calibration_windows_are_slices_of_the_stream(spark):
    rows = [(i, list(range(1, 1 + (i * 37) % 50))) for i in range(200)]
    stream = [x for _, ids in rows for x in ids + [0]]
    df = spark.createDataFrame(rows, "id bigint, ids array<int>")
    drawn = tokens.calibration_windows(df, "id", "ids", 20, 100, 3).collect()
    assert len(drawn) == 20 and all(w.ids == stream[w.start : w.start + 100] for w in drawn)


def test_folds_partition_rows_and_keep_groups(tables):
    folded = splits.balanced_group_folds(tables.documents, "text", 5)
    assert folded.count() == tables.documents.count()
    assert splits.leaking_groups(folded, "text").count() == 0
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 5


def test_tags_to_spans_and_back(spark):
    spans = [(1, "A", 0, 3), (1, "B", 4, 4), (1, "A", 7, 9), (2, "B", 1, 2)]
    df = spark.createDataFrame(spans, "doc_id int, class string, start_word int, end_word int")
    sizes = spark.createDataFrame([(1, 10), (2, 3), (3, 2)], "doc_id int, n_words int")
    tags = labels.bio_tags(sizes, df, "doc_id")
    assert tags.count() == 15
    back = labels.tag_spans(tags, "doc_id").select("doc_id", "class", "start_word", "end_word")
    assert sorted(map(tuple, back.collect())) == sorted(spans)


def test_contained_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    pts = [(int(d), int(s), int(s + w)) for d, s, w in zip(rng.integers(0, 3, 500), rng.integers(0, 5000, 500), rng.integers(1, 9, 500))]
    sps = [(int(d), int(s), int(s + w)) for d, s, w in zip(rng.integers(0, 3, 60), rng.integers(0, 5000, 60), rng.integers(1, 900, 60))]
    left = spark.createDataFrame(pts, "k int, tok_start int, tok_end int")
    right = spark.createDataFrame(sps, "k int, span_start int, span_end int")
    got = sorted(map(tuple, joins.contained(left, right, "k").select("k", "tok_start", "tok_end", "span_start", "span_end").collect()))
    want = sorted((k, a, b, s, e) for k, a, b in pts for j, s, e in sps if k == j and a >= s and b <= e)
    assert got == want
    kept = joins.contained(left, right, "k", how="left").select("k", "tok_start", "tok_end").distinct().count()
    assert kept == len(set(pts))


def test_stop_list_keeps_rows_and_nulls(spark):
    rows = [(1, "The cat sat"), (2, "the"), (3, ""), (4, None), (1, "sat up")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    stop = spark.createDataFrame([("the",), ("sat",), ("the",)], "word string")
    got = texts.remove_stop_words(df, tx.words(F.col("text")), stop, "kept", limit=2).collect()
    assert sorted((r.id, r.text or "", r.kept) for r in got) == [
        (1, "The cat sat", ["cat"]), (1, "sat up", ["up"]), (2, "the", []), (3, "", []), (4, "", None),
    ]
    with pytest.raises(ValueError):
        texts.remove_stop_words(df, tx.words(F.col("text")), stop, "kept", limit=1)


def test_window_draws_at_cluster_size(spark):
    total, length = 25_000_000_000_000, 2048
    starts = [r.s for r in spark.range(2000).select(tokens.window_start(F.col("id"), 1, total, length).alias("s")).collect()]
    assert 0 <= min(starts) < total // 50 and total - total // 50 < max(starts) <= total - length
    short = spark.range(5).select(tokens.window_start(F.col("id"), 1, 10, 256).alias("s")).collect()
    assert [r.s for r in short] == [0] * 5


def test_null_group_and_order_at_any_block_size(spark):
    rows = [(None, 3, None), (None, 1, 5.0), ("a", 2, None), ("a", 4, 7.0), ("a", 6, None), ("a", None, None)]
    df = spark.createDataFrame(rows, "g string, i bigint, x double")
    want = [("None", 1, 5.0), ("None", 3, 5.0), ("a", -1, 7.0), ("a", 2, 7.0), ("a", 4, 7.0), ("a", 6, 7.0)]
    for size in (1, 2, 1_000_000):
        filled = ordering.fill_gaps(df, ["g"], "i", "x", rows_per_block=size).collect()
        assert sorted((str(r.g), -1 if r.i is None else r.i, r.x) for r in filled) == want
        assert ordering.grouped_offset(df, "g", "i", F.lit(1), "n", rows_per_block=size).count() == 6
    assert ordering.dense_index(df.limit(0), "i", "n").count() == 0


def test_first_copy_wins(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "i bigint, text string")
    kept = tables_distinct(df)
    assert kept["same"] == 0 and len(kept) == 201


def tables_distinct(df):
    return {r.text: r.i for r in tables.distinct_by(df, ["text"], "i").withColumnRenamed("i", "i").collect()}


def test_fill_gaps(spark):
    rows = [(1, 0, None), (1, 1, 2.0), (1, 2, None), (2, 0, None)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    got = ordering.fill_gaps(df, ["g"], "i", "v").orderBy("g", "i").collect()
    assert [r.v for r in got] == [2.0, 2.0, 2.0, None]


def test_fill_gaps_over_many_blocks(spark, skewed):
    pdf, df = skewed
    holes = pdf.assign(x=np.where(pdf.v < 40, np.nan, pdf.v))
    gaps = df.withColumn("x", F.when(F.col("v") >= 40, F.col("v").cast("double")))
    got = ordering.fill_gaps(gaps, ["g"], "i", "x", rows_per_block=100).toPandas().sort_values("i")
    want = holes.sort_values("i").groupby("g").x.transform(lambda s: s.ffill().bfill())
    assert got.x.fillna(-1).to_list() == want.fillna(-1).to_list()


def test_box_summary_equals_numpy(skewed):
    pdf, df = skewed
    got = st.box_summary(df, "v").first()
    assert [got.q1, got.median, got.q3] == list(np.percentile(pdf.v, [25, 50, 75]))
    assert got.n == len(pdf)
    near = st.approximate_summary(df, "v").first()
    assert abs(near.median - got.median) <= 1


def test_noise_vectors_are_repeatable(spark):
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 6.0])], "word string, vec array<float>")
    words = spark.createDataFrame([("a",), ("z",)], "word string")
    runs = [{r.word: list(r.vec) for r in joins.vectors_with_default(words, vectors, noise_seed=5).collect()} for _ in (0, 1)]
    assert runs[0] == runs[1] and runs[0]["a"] == [1.0, 2.0] and runs[0]["z"] != [2.0, 4.0]


def test_length_layout_is_sorted(tables):
    from textloom.sources.writers import length_ordered

    laid = length_ordered(tables.documents.select("doc_id", "n_chars"), F.col("n_chars"), 4)
    parts = laid.select(F.spark_partition_id().alias("p"), "n_chars").toPandas()
    assert all(g.n_chars.is_monotonic_increasing for _, g in parts.groupby("p"))
    bounds = parts.groupby("p").n_chars.agg(["min", "max"])
    assert (bounds["max"].shift().fillna(0) <= bounds["min"]).all()
