"""Runs and previous values cut into blocks, against a plain pass over each group."""

from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import labels, ordering, splits


def _table(spark, rows):
    return spark.createDataFrame(rows, "g string, pos long, value string, opens boolean")


def _rows(rng, sizes, stay):
    """Values that stay with probability `stay`, nulls among them; a few places are missing and a few rows open a run."""
    rows = []
    for g, size in sizes.items():
        now = "a"
        for pos in range(size):
            if rng.random() > stay:
                now = [None, "a", "b"][rng.integers(3)]
            if rng.random() < 0.95:
                rows.append((g, pos, now, bool(rng.random() < 0.02)))
    return [rows[i] for i in rng.permutation(len(rows))]


def _plain_runs(rows, with_opens):
    found = []
    for g, members in groupby(sorted(rows, key=lambda r: (r[0] or "", r[1])), key=lambda r: r[0]):
        run = None
        for _, pos, value, opens in members:
            if run and run[1] == value and not (with_opens and opens):
                run[3], run[4] = pos, run[4] + 1
            else:
                run = [g, value, pos, pos, 1]
                found.append(run)
    return sorted(map(tuple, found), key=lambda r: (r[0] or "", r[2]))


@pytest.mark.parametrize("places", [1, 7, 50, 65_536])
@pytest.mark.parametrize("stay", [0.3, 0.9, 0.999])
def test_runs_equal_a_plain_pass(spark, places, stay):
    rng = np.random.default_rng(places)
    rows = _rows(rng, {"hot": 1_000, "cold": 60, "one": 1, None: 90}, stay)
    block = ordering.place_block("pos", places)
    for opens in (None, F.col("opens")):
        found = ordering.runs(_table(spark, rows), ["g"], "pos", "value", opens=opens, block=block).collect()
        found = sorted(((r.g, r.value, r.start, r.end, r.n) for r in found), key=lambda r: (r[0] or "", r[2]))
        assert found == _plain_runs(rows, opens is not None)


def test_one_run_over_twenty_blocks(spark):
    df = spark.range(1_000).select(F.lit("x").alias("g"), F.col("id").alias("pos"), F.lit("v").alias("value"))
    found = ordering.runs(df, ["g"], "pos", "value", block=ordering.place_block("pos", 50)).collect()
    assert [tuple(r) for r in found] == [("x", "v", 0, 999, 1_000)]


def test_every_row_a_run(spark):
    df = spark.range(10_000).select(F.lit("x").alias("g"), F.col("id").alias("pos"), F.col("id").cast("string").alias("value"))
    found = ordering.runs(df, ["g"], "pos", "value", block=ordering.place_block("pos", 500))
    assert found.filter("start = end and n = 1 and value = cast(start as string)").count() == found.count() == 10_000


def test_previous_values_and_violations(spark):
    rng = np.random.default_rng(5)
    rows = [(g, pos, None if rng.random() < 0.1 else int(rng.integers(9))) for g in ("hot", None) for pos in range(300)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "g string, pos long, value long")
    block = ordering.place_block("pos", 16)
    want = {(g, pos): None if pos == 0 else rows[i - 1][2] for i, (g, pos, _) in enumerate(rows)}
    found = ordering.previous_value(df, ["g"], "pos", "value", "previous", block)
    assert {(r.g, r.pos): r.previous for r in found.collect()} == want
    bad = splits.violations_in_order(df, "g", "pos", "value", block).collect()
    less = {(g, p) for g, p, v in rows if v is not None and want[g, p] is not None and v <= want[g, p]}
    assert {(r.g, r.pos) for r in bad} == less


def test_empty_table_has_no_runs(spark):
    df = _table(spark, [])
    assert ordering.runs(df, ["g"], "pos", "value").count() == 0
    assert labels.equal_runs(df, "g", "pos", "value").columns == ["g", "value", "start_pos", "end_pos", "run_length"]
    assert ordering.previous_value(df, ["g"], "pos", "value", "previous").count() == 0
