"""Helpers shared by the operators: stored tables, Arrow maps, connected components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.sources.scratch import new_path

WORD_SPACE = " \t\n\x0b\f\r"  # fixed values: what separates words, \x20 and \x09-\x0D
ROWS_PER_OUTPUT = 50_000


class Stored:
    """A table written to the shared folder, and its path, so that it can be deleted when used up."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)


def discard(*tables: Stored) -> None:
    """Delete stored tables that no later step reads, and let Spark drop unused shuffle files.

    Shuffle files go when the driver's objects for them are collected; a chain of
    stored steps would otherwise keep all of them until the end.
    """
    for table in tables:
        jvm = table.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.path)
        path.getFileSystem(table.spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        collect_garbage(tables[0].spark)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files that no live object refers to."""
    gc.collect()
    spark._jvm.System.gc()


def map_batches(df: DataFrame, fn: Callable, schema: str, **params) -> DataFrame:
    """`mapInArrow` over `fn(batches, schema, **params)`, where `schema` is the Arrow schema of the result.

    `fn` yields dictionaries of equal-length columns. Workers wait for further tasks, also while other stages use
    the executor's memory, so a task gives back what it has freed.
    """
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches, **params):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
            )
        columns = None
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give memory that this process has freed back to the system: Arrow's, and that of the C library."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema for the flat column types the operators return."""
    kinds = {
        T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(),
        T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
        T.ArrayType(T.LongType()): pa.list_(pa.int64()), T.ArrayType(T.IntegerType()): pa.list_(pa.int32()),
        T.ArrayType(T.StringType()): pa.list_(pa.string()),
    }
    return pa.schema([(f.name, kinds[f.dataType]) for f in T.StructType.fromDDL(schema)])


def utf8(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return (value.as_py() for value in column)


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def word_count(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    empty_ends = (F.element_at(parts, 1) == "").cast("int") + (
        (F.size(parts) > 1) & (F.element_at(parts, -1) == "")
    ).cast("int")
    return (F.size(parts) - empty_ends).cast("long")


def id_or_last(column: str = "doc_id") -> Column:
    """The id, with null as the largest, so that a row without one is never the first of a group."""
    return F.coalesce(F.col(column), F.lit((1 << 63) - 1))


def components(edges: DataFrame, rounds: int = 60) -> Stored:
    """`(node, root)`: each node of `edges(a, b)` and the smallest node it is connected to.

    Large-star and small-star steps until no edge changes: each node moves to the smallest
    neighbour it knows of, which takes about log(size) rounds even for long chains. Hubs do not
    gather their neighbours: the minimum of a node combines before the shuffle. Every round is a
    stored table, so a lost executor repeats one round at most.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = Stored(edges.filter("a != b").select(a, b).distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = now.df.unionByName(now.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = Stored(large.filter("a != b").distinct(), "edges")
        least = large.df.groupBy("a").agg(F.min("b").alias("m"))
        small = large.df.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        after = Stored(small.filter("a != b").distinct(), "edges")
        discard(now, large)
        now = after
        seen = now.df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    found = Stored(now.df.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components")
    discard(now)
    return found
