"""Quality by a sparse ensemble of rules.

Statistics of a text (`STATISTICS`) are numbers of its words, lines and marks.
A forest of small trees is grown on the statistics of labelled rows; every path
from a root to a node is a conjunction of bounds on statistics, a rule. A
logistic regression with a lasso penalty over the rules keeps the few that
matter, and these are compiled into one column expression over the statistics,
which scores every row of the table.

Labels are read only from rows that are not held out. At most about
`labelled_rows` of them, chosen by a hash of the id, are learned from, each text
once; label, language, source and id are never inputs of a score. The number of
rules is bounded by the number and depth of the trees.

Null and empty texts have all statistics zero and are scored like any other.
Rows repeated in `labels` count once, as good only if all of them say so; a null
label or id is no label. A null id is not held out. Without labels of both
classes the score is the share of good labels, drawn towards a half. Repeated
rows of `docs` have a row each, and an empty table gives none. Columns other
than those named are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, discard, map_batches, utf8, values
from textloom.sources.scratch import new_path

STATISTICS = (
    "n_words", "word_length", "longest_word", "distinct_share", "top_share", "again_share", "triple_share", "capital_share",
    "navigation_share", "symbol_share", "exclaim_share", "digit_share", "mark_share", "letter_share",
    "n_lines", "line_words", "line_repeat_share", "short_line_share", "ended_share",
)
NAVIGATION, SYMBOLS, MARKS = "|»›•", "#*$%&<>{}[]\\^~=_@", ".,;:?"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS = re.compile(r"[0-9]")
_LETTERS = re.compile(r"[^\W\d_]")


def statistics(text: str) -> tuple[float, ...]:
    """The values of `STATISTICS` for one text; shares are of words, characters or lines."""
    words = _WORDS.findall(text)
    if not words:
        return (0.0,) * len(STATISTICS)
    n, chars = len(words), sum(map(len, words))
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    lines = [line for line in text.split("\n") if not line.isspace() and line]
    sizes = [len(_WORDS.findall(line)) for line in lines]
    return (
        math.log1p(n), chars / n, math.log1p(max(map(len, words))), len(counts) / n, counts.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(k for k in triples.values() if k > 1) / n,
        sum(word.isupper() and len(word) > 1 for word in words) / n,
        sum(map(text.count, NAVIGATION)) / n,
        sum(map(text.count, SYMBOLS)) / chars,
        text.count("!") / n,
        len(_DIGITS.findall(text)) / chars,
        sum(map(text.count, MARKS)) / n,
        len(_LETTERS.findall(text)) / chars,
        math.log1p(len(lines)), n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(size < 4 for size in sizes) / max(1, len(lines)),
        sum(line.rstrip()[-1] in ".!?" for line in lines) / max(1, len(lines)),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each named statistic, above `low` and up to `high`."""

    bounds: tuple[tuple[str, float, float], ...]

    def narrowed(self, name: str, low: float, high: float) -> Rule:
        now = {s: (a, b) for s, a, b in self.bounds}
        a, b = now.get(name, (-math.inf, math.inf))
        now[name] = (max(a, low), min(b, high))
        return Rule(tuple((s, *now[s]) for s in STATISTICS if s in now))

    def column(self) -> Column:
        """The rule as a condition on the columns of the statistics."""
        parts = [F.col(s) > a for s, a, _ in self.bounds if a > -math.inf]
        parts += [F.col(s) <= b for s, _, b in self.bounds if b < math.inf]
        return reduce(Column.__and__, parts)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def with_statistics(docs: DataFrame, key: str, kind: str = "long") -> DataFrame:
    """`key` and the statistics of each row of `docs(key, text)`."""
    schema = ", ".join([f"{key} {kind}", *(f"{name} double" for name in STATISTICS)])
    return map_batches(docs.select(key, "text"), _statistics, schema, key=key)


def _statistics(batches, key):
    for batch in batches:
        rows = [statistics((text or b"").decode()) for text in utf8(batch, "text")]
        yield {key: values(batch, key), **dict(zip(STATISTICS, zip(*rows)))}


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> Stored:
    """`(good, statistics)` of about `most` labelled rows that are not held out, each text once.

    The chosen ids are at most about `most`, a parameter, so they may be broadcast.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good"))
    share = min(1.0, most / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.min("good").cast("long").alias("good"))
    return Stored(with_statistics(once, "good"), "labelled")


def tree_rules(model: RandomForestClassificationModel, spark) -> list[Rule]:
    """Every path from a root to a node of the forest, as the stored model lists them."""
    path = new_path(spark, "forest")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # bounded by trees and depth
    at = {(r.treeID, r.id): r for r in nodes}
    found: dict[Rule, None] = {}

    def descend(tree: int, number: int, rule: Rule) -> None:
        if rule.bounds:
            found[rule] = None
        node = at[tree, number]
        if node.leftChild >= 0:
            name, cut = STATISTICS[node.split.featureIndex], node.split.leftCategoriesOrThreshold[0]
            descend(tree, node.leftChild, rule.narrowed(name, -math.inf, cut))
            descend(tree, node.rightChild, rule.narrowed(name, cut, math.inf))

    for tree in sorted({t for t, _ in at}):
        descend(tree, 0, Rule(()))
    return list(found)


@dataclass
class RuleModel:
    """Rules with their weights, and the logit of a row that meets none."""

    weights: list[tuple[Rule, float]]
    bias: float

    def score(self) -> Column:
        """The share of good rows among rows like this one, as an expression over the statistics."""
        terms = [F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.weights]
        return 1 / (1 + F.exp(-reduce(Column.__add__, terms, F.lit(self.bias))))


def fit(rows: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 5e-4, seed: int = 11) -> RuleModel:
    """Rules and lasso weights from `rows(good, statistics)`; at most trees * (2^(depth + 1) - 2) rules."""
    sizes = {r.good: r.n for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}  # two rows
    good, bad = (sizes.get(k, 0) for k in (1, 0))
    if not good or not bad:
        return RuleModel([], math.log((good + 1) / (bad + 1)))
    # Both classes weigh the same while trees look for splits; the regression sees the rows as they are.
    weight = F.when(F.col("good") == 1, F.lit(0.5 / good)).otherwise(F.lit(0.5 / bad)) * (good + bad)
    table = rows.select(
        F.col("good").cast("double").alias("label"), weight.alias("weight"), array_to_vector(F.array(*STATISTICS)).alias("features"), *STATISTICS
    )
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=256, minInstancesPerNode=3, weightCol="weight", seed=seed)
    rules = tree_rules(forest.fit(table), rows.sparkSession)
    if not rules:
        return RuleModel([], math.log((good + 1) / (bad + 1)))
    met = F.array(*[rule.column().cast("double") for rule in rules])
    stored = Stored(table.select("label", array_to_vector(met).alias("features")), "rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=80, standardization=False)
    lasso = lasso.fit(stored.df)
    discard(stored)
    weights = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(weights, float(lasso.intercept))


def quality_scores(docs: DataFrame, labels: DataFrame, labelled_rows: int = 16_000, threshold: float = 0.7, **settings) -> DataFrame:
    """`(doc_id, held_out, score, predicted)` of every row of `docs(doc_id, text)`; labels are `labels(doc_id, quality)`."""
    sample = labelled(docs, labels, labelled_rows)
    model = fit(sample.df, **settings)
    discard(sample)
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    scored = rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
