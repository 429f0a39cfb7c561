"""Sinks: partitioned columnar tables, delimited text, JSON-lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", **options) -> str:
    """Write and return the path.  Array dumps and pickles become parquet too."""
    df.write.mode("errorifexists").partitionBy(*partition_by).format(fmt).options(**options).save(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    options = {"header": True, "sep": sep, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return write_table(df, path, fmt="csv", **options)


def write_json_lines(lines: DataFrame, path: str) -> str:
    """`lines` has one string column that already holds a JSON text."""
    return write_table(lines, path, fmt="text")


def length_ordered(df: DataFrame, length: Column, partitions: int | None = None) -> DataFrame:
    """Lay rows of like length side by side, so that padded batches waste little.

    The row hash after the length spreads a length that very many rows share.
    """
    tie = F.xxhash64(*df.columns)
    keys = [length, tie]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)
