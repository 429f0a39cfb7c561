"""Row filters, recodes, unions and exact de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import words


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column before and after dropping every row that has one, in one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    sums = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"before_{c}") for c in columns]
    sums += [F.sum((complete & F.col(c).isNull()).cast("bigint")).alias(f"after_{c}") for c in columns]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"before_{c}").alias("nulls_before"), F.col(f"after_{c}").alias("nulls_after")
            )
            for c in columns
        ]
    )
    one = df.agg(*sums, F.count("*").alias("rows_before"), F.sum(complete.cast("bigint")).alias("rows_after"))
    return one.select(F.explode(rows).alias("r"), "rows_before", "rows_after").select("r.*", "rows_before", "rows_after")


def drop_placeholders(df: DataFrame, text: str, values: Sequence[str]) -> DataFrame:
    """Strip the text and drop rows that are nothing but a placeholder."""
    return df.withColumn(text, F.trim(text)).filter(~F.col(text).isin(list(values)))


def recode(column: Column, mapping: Mapping, other: Column | None = None) -> Column:
    """Map values; unlisted ones become `other` (null by default)."""
    out = None
    for old, new in mapping.items():
        out = F.when(column == old, new) if out is None else out.when(column == old, new)
    return out.otherwise(other) if other is not None else out


def publication_year(reference: Column) -> Column:
    """The last four characters as a year, null when they are not a number."""
    return F.right(reference, F.lit(4)).try_cast("int")


def first_category(df: DataFrame, categories: Column, names: DataFrame) -> DataFrame:
    """Name of the first blank-separated category; rows with an unknown one are dropped."""
    coded = df.withColumn("code", F.split_part(categories, F.lit(" "), F.lit(1)))
    return coded.join(names, "code")


def distinct_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the first row, by `order`, of each key.

    `min_by` is combined before the shuffle, so a key with very many copies
    sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col(order))
    return df.groupBy(*keys).agg(first.alias("r")).select(*keys, "r.*")


def union_with_class(tables: Mapping[int, DataFrame], out: str) -> DataFrame:
    """Stack tables by column name, each tagged with its class."""
    tagged = [df.withColumn(out, F.lit(code)) for code, df in tables.items()]
    stacked = tagged[0]
    for more in tagged[1:]:
        stacked = stacked.unionByName(more)
    return stacked


def word_set_overlap(left: Column, right: Column) -> tuple[Column, Column]:
    """Distinct words in both texts, and in the left one only."""
    a, b = words(left), words(right)
    return F.array_intersect(a, b), F.array_except(a, b)
