"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register `fn(tables)`; `sql` is the same result in DuckDB SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def csv(column: Column | str) -> Column:
    """An array as comma-separated text, so that engines compare by value."""
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


def r(column: Column | str, digits: int = 6) -> Column:
    """Round so that the last bits of a sum do not matter."""
    return F.round(F.col(column) if isinstance(column, str) else column, digits)
