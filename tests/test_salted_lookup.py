"""Salted lookups of words against plain joins."""

import pytest
from pyspark.sql import functions as F

from textloom.operators import joins


def _rows(spark):
    """A third of all rows hold one word; a few hold none."""
    word = F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("w"), F.col("id") % 700))
    return spark.range(9_000).select((F.col("id") % 40).alias("doc"), F.col("id").alias("pos"), word.alias("word"))


def _mapping(spark):
    """Two rows for the frequent word, one for some others, one that no row has, and one without a word."""
    rows = [("the", "a"), ("the", "b"), (None, "n"), ("unused", "u"), *((f"w{i}", str(i)) for i in range(0, 700, 2))]
    return spark.createDataFrame(rows, "word string, replacement string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_a_plain_join(spark, how):
    rows, mapping = _rows(spark), _mapping(spark)
    want = rows.join(mapping, "word", how)
    found = joins.salted_lookup(rows, mapping, "word", ["doc", "pos"], how)
    assert found.columns == want.columns
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0


def test_only_frequent_keys_are_salted(spark):
    rows = _rows(spark)
    assert joins.frequent_keys(rows, "word", parts=100) == ["the"]
    assert joins.frequent_keys(rows.limit(0), "word") == []


def test_a_frequent_key_is_dealt_over_the_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for name, value in zip(before, ("-1", "false", "16")):
            spark.conf.set(name, value)
        rows, mapping = _rows(spark), _mapping(spark).filter("replacement <> 'b'")
        most = []
        for heavy in ([], ["the"]):
            found = joins.salted_lookup(rows, mapping, "word", ["doc", "pos"], "inner", heavy=heavy)
            sizes = found.groupBy(F.spark_partition_id().alias("p")).count()
            most.append(max(r["count"] for r in sizes.collect()))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert most[0] >= 3_000 and most[1] <= most[0] / 3


def test_other_kinds_of_joins_are_refused(spark):
    with pytest.raises(ValueError):
        joins.salted_lookup(_rows(spark), _mapping(spark), "word", ["pos"], how="outer")
