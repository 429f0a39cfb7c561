"""Strings within an edit distance of each other, without a block key.

An edit touches at most `q` of a string's q-grams, so two strings within `d`
edits share one of their first `q * d + 1` q-grams in any order that both use
(prefix filter). The order puts rare q-grams first, which keeps the lists of
strings that share one short. Strings meet on (q-gram, length), the lengths at
most `d` apart and the q-gram's places too; Spark's `levenshtein` with a limit
decides. Pairs that are too short to share a q-gram of two characters meet on
single characters, and those within `d` characters of the empty string on their
length alone: there every pair is a result.

Equal strings are one class, so copies meet no one twice: `fuzzy_pairs` gives
the pairs of classes, `fuzzy_links` each row's class and number of linked rows.
Null strings belong to no class. Empty strings are strings. An empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.sources.scratch import durable

FREQUENT = 10_000  # q-grams ranked by their count; all others count as rare
EDGE = "\x00"  # stands before and after a string


def classes(rows: DataFrame, key: str, text: str) -> DataFrame:
    """`(id, value, n)`: each different string once, with the smallest key and the number of its rows."""
    return rows.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("value")).agg(
        F.min(key).alias("id"), F.count("*").alias("n")
    )


def grams(value: Column, q: int) -> Column:
    """`(gram, at)` of a string, with its edges for q over 1; the n-th equal gram is another one than the first."""
    padded = F.concat(F.lit(EDGE * (q - 1)), value, F.lit(EDGE * (q - 1))) if q > 1 else value
    n = F.length(padded) - (q - 1)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(padded, i, F.lit(q)))
    cut = F.when(n > 0, cut).otherwise(F.array().cast("array<string>"))
    earlier = lambda g, i: F.size(F.filter(F.slice(cut, F.lit(1), i), lambda x: x == g))
    return F.transform(cut, lambda g, i: F.struct(F.concat(g, F.lit(EDGE), earlier(g, i).cast("string")).alias("gram"), i.alias("at")))


def prefixes(names: DataFrame, q: int, distance: int) -> DataFrame:
    """`(id, value, size, q, gram, at)`: the first `q * distance + 1` q-grams of each of `names(id, value)`, rare ones first."""
    rows = names.select("id", "value", F.length("value").alias("size"), F.explode(grams(F.col("value"), q)).alias("g")).select(
        "id", "value", "size", "g.gram", "g.at"
    )
    often = rows.groupBy("gram").agg(F.count("*").alias("uses")).orderBy(F.desc("uses"), "gram").limit(FREQUENT)
    ranked = rows.join(F.broadcast(often), "gram", "left")  # at most FREQUENT rows
    order = F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "gram", "at")
    first = F.slice(F.array_sort(F.collect_list(order)), 1, q * distance + 1)  # the grams of one string
    found = ranked.groupBy("id", "value", "size").agg(first.alias("first"))
    return found.select("id", "value", "size", F.lit(q).alias("q"), F.explode("first").alias("g")).select(
        "id", "value", "size", "q", "g.gram", "g.at"
    )


def fuzzy_pairs(names: DataFrame, distance: int) -> DataFrame:
    """`(a, b, a_value, b_value, distance)`, a < b, of all pairs of `names(id, value)` with at most that edit distance.

    `names` holds each string once.
    """
    names = durable(names.select("id", "value"))
    size = F.length("value")
    # Two strings share a 2-gram with edges if the longer one has at least 2 * distance characters.
    lists = prefixes(names, 2, distance)
    lists = lists.unionByName(prefixes(names.filter(size < 2 * distance), 1, distance))
    lone = names.filter(size <= distance).select(
        "id", "value", size.alias("size"), F.lit(0).alias("q"), F.lit("").alias("gram"), F.lit(0).alias("at")
    )
    lists = durable(lists.unionByName(lone))
    reach = F.explode(F.sequence(F.col("size"), F.col("size") + distance)).alias("other_size")
    short = lists.select(*[F.col(c).alias(f"a_{c}") for c in ("id", "value", "size", "q", "gram", "at")], reach)
    near = (
        (F.col("a_q") == F.col("q")) & (F.col("a_gram") == F.col("gram")) & (F.col("other_size") == F.col("size"))
        & (F.abs(F.col("a_at") - F.col("at")) <= distance)
        & ((F.col("a_size") < F.col("size")) | (F.col("a_id") < F.col("id")))
    )
    met = short.join(lists, near).select(
        "a_id", "id", "a_value", "value", F.levenshtein("a_value", "value", distance).alias("distance")
    )
    close = met.filter(F.col("distance") >= 0).distinct()
    turned = F.col("a_id") > F.col("id")
    pick = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    return close.select(
        pick("id", "a_id").alias("a"), pick("a_id", "id").alias("b"),
        pick("value", "a_value").alias("a_value"), pick("a_value", "value").alias("b_value"), "distance",
    )


def fuzzy_links(rows: DataFrame, key: str, text: str, distance: int) -> DataFrame:
    """`(key, class_id, links)`: the smallest key with the same string, and the number of other rows within the distance."""
    named = durable(classes(rows, key, text))
    pairs = fuzzy_pairs(named, distance).select("a", "b")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(named.select(F.col("id").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    totals = named.join(others, F.col("id") == F.col("a"), "left").select(
        "value", F.col("id").alias("class_id"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links")
    )
    found = rows.select(key, F.col(text).alias("__text")).join(totals, F.col("__text") == F.col("value"), "left")
    return found.select(key, "class_id", F.coalesce("links", F.lit(0)).alias("links"))
