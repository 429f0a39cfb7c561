"""Array arithmetic that stays inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.arrays import let


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def scale_unit(values: Column) -> Column:
    """Min-max scaling to [0, 1]; a constant array becomes zeros."""

    def scale(bounds):
        width = bounds["high"] - bounds["low"]
        unit = lambda x: F.coalesce(F.try_divide(x.cast("double") - bounds["low"], width), F.lit(0.0))
        return F.transform(bounds["x"], unit)

    low, high = F.array_min(values).cast("double"), F.array_max(values).cast("double")
    return let(F.struct(values.alias("x"), low.alias("low"), high.alias("high")), scale)


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities of one row's logits."""

    def exponentials(x):
        return let(F.array_max(x), lambda peak: F.transform(x, lambda v: F.exp(v - peak)))

    def divide(e):
        return let(total(e), lambda s: F.transform(e, lambda v: v / s))

    scaled = F.transform(logits, lambda x: x.cast("double") / temperature)
    return let(let(scaled, exponentials), divide)


def ranked(values: Column) -> Column:
    """`(value, index)` structs, largest value first, ties by lower index."""
    keyed = F.transform(values, lambda x, i: F.struct((-x).alias("minus"), i.alias("idx")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct((-s["minus"]).alias("value"), s["idx"].alias("idx")))


def argmax(values: Column) -> Column:
    """0-based index of the largest value, the lowest index on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def mean_vector(vector: str, dims: int, weight: Column | None = None) -> Column:
    """Aggregate: the (weighted) mean of an array column, one sum per dimension."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    floor = F.greatest(F.sum(w), F.lit(1e-9))
    return F.array(*[F.sum(F.col(vector)[i].cast("double") * w) / floor for i in range(dims)])
