"""Scans of delimited, JSON-lines, plain-text and vector files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.ordering import dense_index

_CORRUPT = "__corrupt"


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", rows: int | None = None, **options
) -> DataFrame:
    """CSV or TSV with a header row and a declared schema; `rows` keeps the first rows only."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep)
    df = reader.options(**options).csv(path)
    return df if rows is None else df.limit(rows)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()
) -> DataFrame:
    """JSON-lines; lines that do not parse or lack a required field are skipped."""
    lines = spark.read.text(path)
    return parse_json_lines(lines, schema, required)


def parse_json_lines(lines: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = lines.select(parsed.alias("r")).filter(F.col("r").isNotNull() & F.col(f"r.{_CORRUPT}").isNull())
    fields = rows.select(*[f"r.{f.name}" for f in schema.fields])
    return fields.dropna(subset=list(required)) if required else fields


def read_csv_with_column(
    spark: SparkSession, paths: str | Sequence[str], column: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Rows of `column` from the CSV files that have it, and the files that lack it.

    Headers are read by Spark; the driver only sees one line per file.
    """
    first_block = (
        spark.read.text(paths)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .filter("file_block_start = 0")
        .withColumn("at", F.monotonically_increasing_id())
    )
    headers = first_block.groupBy("file_path").agg(F.min_by("value", "at").alias("header")).collect()
    by_header: dict[str, list[str]] = {}
    for row in headers:
        by_header.setdefault(row.header, []).append(row.file_path)
    found, missing = [], []
    for header, files in by_header.items():
        names = [name.strip().strip('"') for name in header.split(",")]
        if column in names:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            reader = spark.read.schema(schema).option("header", True).options(**options)
            found.append(reader.csv(files).select(column))
        else:
            missing.extend(files)
    if not found:
        raise ValueError(f"no file has a column named {column}")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows, spark.createDataFrame([(m,) for m in missing], "file string")


def read_text_files(spark: SparkSession, path: str, id_pattern: str = r"([^/]+)\.txt$") -> DataFrame:
    """One row per file: the id taken from the path, and the whole text."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).alias("id"), F.col("value").alias("text")
    )


def parse_word_vectors(lines: DataFrame) -> DataFrame:
    """`word v1 ... vn` lines to `(word, vec)`."""
    parts = F.split("value", " ")
    return lines.select(
        F.element_at(parts, 1).alias("word"),
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).cast("array<float>").alias("vec"),
    )


def percent_slice(df: DataFrame, order: str, lower: float, upper: float) -> DataFrame:
    """Rows from `lower` to `upper` percent along a unique numeric column."""
    total = df.count()
    return row_range(df, order, int(total * lower // 100), int(total * upper // 100))


def row_range(df: DataFrame, order: str, start: int, stop: int) -> DataFrame:
    """Rows `start <= i < stop` along a unique numeric column."""
    indexed = dense_index(df, order, "row_idx")
    return indexed.filter((F.col("row_idx") >= start) & (F.col("row_idx") < stop))


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Raise when a needed column is missing; a null column would hide the mistake."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def optional_column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def describe_schema(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
