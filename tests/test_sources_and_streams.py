"""Readers, column checks, and stream = batch."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from textloom.sources import readers
from textloom.sources.scratch import new_path, shared_root
from textloom.streaming import streams


def test_files_without_the_column_are_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Title,Lyrics\nx,la la\ny,lo lo\n")
    (tmp_path / "b.csv").write_text("Lyrics,Year\nmi mi,1990\n")
    (tmp_path / "c.csv").write_text("Title,Body\nz,none\n")
    rows, missing = readers.read_csv_with_column(spark, f"{tmp_path}/*.csv", "Lyrics")
    assert sorted(r.Lyrics for r in rows.collect()) == ["la la", "lo lo", "mi mi"]
    assert [r.file.rsplit("/", 1)[1] for r in missing.collect()] == ["c.csv"]
    with pytest.raises(ValueError):
        readers.read_csv_with_column(spark, f"{tmp_path}/c.csv", "Lyrics")


def test_text_folder_ids(spark, tmp_path):
    (tmp_path / "e1.txt").write_text("one\ntwo")
    (tmp_path / "e2.txt").write_text("three")
    got = {r.id: r.text for r in readers.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"e1": "one\ntwo", "e2": "three"}


def test_first_rows_only(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\n" + "".join(f"{i}\tx\n" for i in range(50)))
    assert readers.read_delimited(spark, str(tmp_path), "a int, b string", sep="\t", rows=10).count() == 10


def test_required_and_optional_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="missing columns"):
        readers.require_columns(df, ["a", "system"])
    assert df.select(readers.optional_column(df, "context").alias("c")).first().c is None
    assert [r.column for r in readers.describe_schema(df).collect()] == ["a", "b"]


def test_scratch_is_under_the_session_folder(spark):
    assert new_path(spark, "x").startswith(shared_root(spark))


def test_history_stream_over_several_batches(spark, tmp_path):
    """State carries over micro-batches; the state never exceeds the budget."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", 10 + t) for c in (1, 2) for t in range(12)]
    pdf = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "tokens"])
    for i in range(3):
        pdf[pdf.turn // 4 == i].to_parquet(tmp_path / f"turns{i}.parquet")
    schema = "conv_id bigint, turn bigint, role string, tokens bigint"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = {(r.conv_id, r.pair_turn): (r.kept_pairs, r.used_tokens) for r in streams.history_stream(source, 100, "t").collect()}
    assert len(got) == 12
    for conv in (1, 2):
        sizes = [(t, 21 + 2 * t) for t in range(0, 12, 2)]
        for k, (turn, _) in enumerate(sizes):
            kept, used = 0, 0
            for _, n in reversed(sizes[: k + 1]):
                if used + n > 100:
                    break
                kept, used = kept + 1, used + n
            assert got[conv, turn] == (kept, used)


def test_distinct_stream_with_watermark(spark):
    events = streams.table_stream(spark, SF, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("text")
    )
    kept = streams.distinct_stream(events, "text", "w", time="ts", delay="40 days")
    assert kept.count() == kept.select("text").distinct().count()


def test_stream_reads_a_table_of_several_part_files(spark, tables, tmp_path):
    from textloom.streaming.streams import run_available, table_stream

    tables.documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = run_available(table_stream(spark, str(tmp_path), "documents", files_per_batch=1), "parts")
    assert got.count() == tables.documents.count()


def test_dense_index_places_null_rows_alike_for_any_block_count(spark):
    from textloom.operators.ordering import dense_index, grouped_offset

    df = spark.createDataFrame([(3,), (1,), (None,), (2,), (5,)], "v int")
    want = {None: 0, 1: 1, 2: 2, 3: 3, 5: 4}
    for rows_per_block in (1, 2, 1_000_000):
        assert {r.v: r.i for r in dense_index(df, "v", "i", rows_per_block).collect()} == want
    grouped = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "g string, v int")
    assert grouped_offset(grouped, "g", "v", F.lit(1), "at").count() == 3
