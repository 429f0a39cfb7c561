"""Choosing among scored candidates inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.vectors import ranked, softmax


def top_choices(probabilities: Column, count: int, prefix: str) -> Column:
    """The `count` likeliest candidates as ` name (12.34%)`."""
    best = F.slice(ranked(probabilities), 1, count)
    return F.transform(
        best, lambda s: F.format_string(f" {prefix}%d (%.2f%%)", s["idx"], s["value"] * 100)
    )


def nucleus(probabilities: Column, share: float) -> Column:
    """Smallest set of likeliest candidates whose probability exceeds `share`, renormalised."""
    seed = F.struct(
        F.lit(0.0).alias("before"), F.array().cast("array<struct<idx:int,p:double>>").alias("kept")
    )

    def step(acc, s):
        grown = F.array_append(acc["kept"], F.struct(s["idx"].cast("int").alias("idx"), s["value"].alias("p")))
        return F.struct(
            (acc["before"] + s["value"]).alias("before"),
            F.when(acc["before"] <= share, grown).otherwise(acc["kept"]).alias("kept"),
        )

    def rescale(acc):
        mass = F.aggregate(acc["kept"], F.lit(0.0), lambda m, s: m + s["p"])
        return F.transform(acc["kept"], lambda s: F.struct(s["idx"].alias("idx"), (s["p"] / mass).alias("p")))

    return F.aggregate(ranked(probabilities), seed, step, rescale)


def route(logits: Column, count: int) -> Column:
    """The `count` best experts with softmax weights over just those."""
    best = F.slice(ranked(logits), 1, count)
    weights = softmax(F.transform(best, lambda s: s["value"]))
    return F.zip_with(best, weights, lambda s, w: F.struct(s["idx"].cast("int").alias("expert"), w.alias("weight")))
