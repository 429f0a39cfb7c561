"""Streams whose state ends: windows, distinct texts and histories over several batches."""

from datetime import datetime, timedelta

import pandas as pd
import pytest

from textloom.streaming import streams

START = datetime(2024, 1, 1)


def _batches(spark, folder, batches, schema):
    """A stream that gives one list of rows in each micro-batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    files = sorted(folder.glob("*/part-*.parquet"))
    target = folder / "all"
    target.mkdir()
    for i, file in enumerate(files):
        pd.read_parquet(file).to_parquet(target / f"b{i}.parquet", coerce_timestamps="us")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(target))


def _run(stream):
    query, path = streams.start_available(stream, "state")
    query.awaitTermination()
    rows = stream.sparkSession.read.schema(stream.schema).parquet(path).collect()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return rows, held


def _at(minutes):
    return START + timedelta(minutes=minutes)


def test_late_rows_are_not_counted_and_closed_windows_leave_the_state(spark, tmp_path):
    batches = [
        [(_at(1), "a"), (_at(30), "a"), (_at(59), "b"), (None, "a"), (_at(61), None)],
        [(_at(50), "a"), (_at(200), "a")],  # within the delay of the first batch: counted
        [(_at(201), "a")],  # rows are held against the watermark of the batch before
        [(_at(5), "a"), (_at(70), "b"), (_at(400), "b")],  # the first two hours are closed: late
        [(_at(4000), "a")],
    ]
    stream = _batches(spark, tmp_path, batches, "ts timestamp, label string")
    rows, held = _run(streams.window_counts(stream, "ts", "label", "1 hour", "10 minutes"))
    got = {(r.window_start, r.label): r.n for r in rows}
    assert got == {(_at(0), "a"): 3, (_at(0), "b"): 1, (_at(60), None): 1, (_at(180), "a"): 2, (_at(360), "b"): 1}
    assert held[-1] == 1 and max(held) <= 4


def test_distinct_texts_of_one_horizon_are_held(spark, tmp_path):
    batches = [[(_at(1000 * b + i % 40), f"text {i % 20} of {b}") for i in range(100)] for b in range(4)]
    batches[1].append((_at(1005), "text 3 of 0"))  # a copy beyond the horizon is a first arrival again
    stream = _batches(spark, tmp_path, batches, "ts timestamp, text string")
    rows, held = _run(streams.distinct_rows(stream, "text", "ts", "1 hour"))
    texts = sorted(r.text for r in rows)
    want = sorted({t for batch in batches for _, t in batch} - {"text 3 of 0"}) + ["text 3 of 0"] * (texts.count("text 3 of 0"))
    assert texts == sorted(want) and texts.count("text 3 of 0") in (1, 2)
    assert max(held) <= 2 * 21 and held[-1] <= 21


def test_copies_inside_the_horizon_are_dropped_by_arrival(spark, tmp_path):
    batches = [[(f"text {i % 7}",) for i in range(30)] for _ in range(3)]
    stream = _batches(spark, tmp_path, batches, "text string")
    rows, held = _run(streams.distinct_rows(stream, "text"))
    assert sorted(r.text for r in rows) == sorted(f"text {i}" for i in range(7)) and max(held) == 7


@pytest.mark.parametrize("horizon_ms, most", [(streams.HORIZON_MS, 30), (1, 20)])
def test_silent_conversations_are_forgotten(spark, tmp_path, horizon_ms, most):
    """Ten new conversations a batch: all are held inside the horizon, those of earlier batches are dropped beyond it."""
    batches = [[(10 * b + c, t, "user" if t % 2 == 0 else "assistant", 5) for c in range(10) for t in range(4)] for b in range(3)]
    stream = _batches(spark, tmp_path, batches, "conv_id bigint, turn bigint, role string, tokens bigint")
    rows, held = _run(streams.histories(stream, 100, horizon_ms, "0 seconds"))
    got = {(r.conv_id, r.pair_turn): (r.kept_pairs, r.used_tokens) for r in rows}
    assert got == {(c, t): (t // 2 + 1, 10 * (t // 2 + 1)) for c in range(30) for t in (0, 2)}
    assert max(held) <= most and (horizon_ms > 1 or held[-1] < 30)


def test_watermark_column_is_not_returned(spark, tmp_path):
    stream = _batches(spark, tmp_path, [[("x",)]], "text string")
    assert streams.distinct_rows(stream, "text").columns == ["text", "h"]
