"""Classification, span, summary and language-model metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import fuzzy
from textloom.functions.arrays import cuts, let
from textloom.sources.scratch import durable

WORDS_AT_ONCE = 200_000


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    cells = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    hit = F.col(label) == F.col(prediction)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col(label).alias("class"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
            F.col("n").alias("support"), zero.alias("predicted"),
        ),
        F.struct(F.col(prediction).alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    counts = cells.select(F.explode(sides).alias("s")).select("s.*").groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = counts.withColumns(
        {
            "precision": ratio(F.col("tp"), F.col("predicted")),
            "recall": ratio(F.col("tp"), F.col("support")),
            "f1": ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")),
        }
    )
    names = ("precision", "recall", "f1")
    per_class = scored.select(F.col("class").cast("string").alias("class"), *names, "support")
    macro = scored.agg(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weight = F.sum("support")
    weighted = scored.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(c) * F.col("support")) / weight).alias(c) for c in names],
        weight.alias("support"),
    )
    share = (F.sum("tp") / weight)
    accuracy = scored.agg(F.lit("accuracy").alias("class"), *[share.alias(c) for c in names], weight.alias("support"))
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return df.groupBy(label).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).fillna(0)


SPAN_BUCKET = 64


def span_matches(truth: DataFrame, predicted: DataFrame, key: str, bucket: int = SPAN_BUCKET) -> DataFrame:
    """Pairs of spans of one class that share words, with both overlap shares.

    Spans are cut into buckets of `bucket` words and meet on `(key, class,
    bucket)`: only near spans are compared and a long text is spread.  A pair
    counts in the bucket where its shared words begin, hence once.
    """

    def placed(df, name):
        reach = F.sequence(F.floor(F.col("start_word") / bucket), F.floor(F.col("end_word") / bucket))
        return df.select(
            key,
            "class",
            F.col("span_id").alias(f"{name}_id"),
            F.col("start_word").alias(f"{name}_from"),
            F.col("end_word").alias(f"{name}_to"),
            F.explode(reach).alias("bucket"),
        )

    begin, end = F.greatest("gt_from", "pred_from"), F.least("gt_to", "pred_to")
    met = placed(truth, "gt").join(placed(predicted, "pred"), [key, "class", "bucket"])
    shared = (end - begin + 1).alias("shared")
    pairs = met.filter((begin <= end) & (F.floor(begin / bucket) == F.col("bucket")))
    length = lambda name: F.col(f"{name}_to") - F.col(f"{name}_from") + 1
    return pairs.select(
        key,
        "class",
        "gt_id",
        "pred_id",
        shared,
        ((end - begin + 1) / length("gt")).alias("overlap_gt"),
        ((end - begin + 1) / length("pred")).alias("overlap_pred"),
    )


def span_f1(truth: DataFrame, predicted: DataFrame, key: str, reference_compat: bool = False) -> DataFrame:
    """Span F1 per class: both overlaps at least one half; the best match counts.

    Inputs: `(key, class, span_id, start_word, end_word)`.  With
    `reference_compat`, classes with truths lacking any prediction in their
    text get one more false positive, and the other way round one more false
    negative, as an outer join's null ids would give.
    """
    hits = span_matches(truth, predicted, key).filter("overlap_gt >= 0.5 AND overlap_pred >= 0.5")
    strength = F.struct(F.greatest("overlap_gt", "overlap_pred"), -F.col("pred_id"))
    chosen = hits.groupBy(key, "class", "gt_id").agg(F.max_by("pred_id", strength).alias("pred_id"))
    found = chosen.groupBy("class").agg(F.count("*").alias("tp"))
    used = chosen.select(key, "class", "pred_id").distinct().groupBy("class").agg(F.count("*").alias("used"))
    gt = truth.groupBy("class").agg(F.count("*").alias("n_gt"))
    pred = predicted.groupBy("class").agg(F.count("*").alias("n_pred"))
    joined = gt.join(pred, "class", "full_outer").join(found, "class", "left").join(used, "class", "left")
    counts = joined.fillna(0, ["n_gt", "n_pred", "tp", "used"]).select(
        "class", "tp", (F.col("n_pred") - F.col("used")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn")
    )
    if reference_compat:
        groups = truth.select(key, "class").distinct().withColumn("g", F.lit(True))
        both = groups.join(predicted.select(key, "class").distinct().withColumn("p", F.lit(True)), [key, "class"], "full_outer")
        missing = both.groupBy("class").agg(
            F.max(F.col("p").isNull().cast("int")).alias("no_pred"), F.max(F.col("g").isNull().cast("int")).alias("no_gt")
        )
        counts = counts.join(missing, "class").select(
            "class", "tp", (F.col("fp") + F.col("no_pred")).alias("fp"), (F.col("fn") + F.col("no_gt")).alias("fn")
        )
    f1 = F.col("tp") / (F.col("tp") + 0.5 * (F.col("fp") + F.col("fn")))
    return counts.withColumn("f1", f1)


def entity_scores(truth: DataFrame, predicted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Micro precision, recall and F1 of exactly equal spans."""
    flag = lambda df, name: df.select(*on).distinct().withColumn(name, F.lit(1))
    both = flag(truth, "t").join(flag(predicted, "p"), list(on), "full_outer")
    counts = both.agg(
        F.sum(F.coalesce("t", F.lit(0)) * F.coalesce("p", F.lit(0))).alias("tp"),
        F.sum("t").alias("n_true"),
        F.sum("p").alias("n_predicted"),
    )
    return counts.select(
        "tp",
        "n_true",
        "n_predicted",
        (F.col("tp") / F.col("n_predicted")).alias("precision"),
        (F.col("tp") / F.col("n_true")).alias("recall"),
        (2 * F.col("tp") / (F.col("n_true") + F.col("n_predicted"))).alias("f1"),
    )


def masked_hits(labels: Column, predictions: Column, ignore: int = -100) -> tuple[Column, Column]:
    """Hits and counted places of two arrays; places labelled `ignore` do not count."""
    pairs = F.filter(F.arrays_zip(labels.alias("l"), predictions.alias("p")), lambda z: z["l"] != ignore)
    hits = F.size(F.filter(pairs, lambda z: z["l"] == z["p"]))
    return hits, F.size(pairs)


def ngrams(words: Column, n: int) -> Column:
    """All runs of n words, joined by blanks."""

    def cut(w):
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1)))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<string>"))

    return let(words, cut)


def ngram_overlap(df: DataFrame, key: str, predicted: Column, reference: Column, orders: Sequence[int]) -> DataFrame:
    """Per text and n: n-grams on both sides and their clipped common count.

    A text is counted where it lies, in Arrow batches. The rows of a key that comes more than once are one text: their
    n-grams meet in a shuffle.
    """
    texts = df.select(key, predicted.alias("p"), reference.alias("r"))
    repeated = durable(df.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("n")).filter("n > 1").select("__key"))
    if repeated.isEmpty():
        return _counted_in_place(texts, key, orders)
    same = F.col(key).eqNullSafe(F.col("__key"))
    alone, several = (texts.join(repeated, same, how) for how in ("left_anti", "left_semi"))
    return _counted_in_place(alone, key, orders).unionByName(_counted_in_shuffle(several, key, orders))


def _counted_in_shuffle(texts: DataFrame, key: str, orders: Sequence[int]) -> DataFrame:
    def tagged(side, is_pred, n):
        mark = lambda g: F.struct(F.lit(n).alias("n"), F.lit(is_pred).alias("is_pred"), g.alias("gram"))
        return F.transform(ngrams(F.col(side), n), mark)

    sides = [tagged(side, is_pred, n) for n in orders for side, is_pred in (("p", 1), ("r", 0))]
    sided = texts.select(key, F.explode(F.flatten(F.array(*sides))).alias("g")).select(key, "g.*")
    grams = sided.groupBy(key, "n", "gram").agg(
        F.sum("is_pred").alias("in_pred"), F.sum(1 - F.col("is_pred")).alias("in_ref")
    )
    return grams.groupBy(key, "n").agg(
        F.sum(F.least("in_pred", "in_ref")).alias("common"), F.sum("in_pred").alias("n_pred"), F.sum("in_ref").alias("n_ref")
    )


def _counted_in_place(texts: DataFrame, key: str, orders: Sequence[int]) -> DataFrame:
    schema = T.StructType([
        texts.schema[key], T.StructField("n", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("common", "n_pred", "n_ref")]
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [pc.fill_null(pc.list_value_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in (1, 2)]
            for start, stop in cuts(sizes[0] + sizes[1], WORDS_AT_ONCE):
                part = batch.slice(start, stop - start)
                words = pa.concat_arrays([part.column(1).flatten(), part.column(2).flatten()])
                for n, *counts in gram_counts(words, sizes[0][start:stop], sizes[1][start:stop], orders):
                    some = np.flatnonzero(counts[1] + counts[2])
                    columns = [part.column(0).take(pa.array(some)), pa.array(np.full(len(some), n), pa.int32())]
                    columns += [pa.array(c[some], pa.int64()) for c in counts]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(run, schema)


def gram_counts(words: pa.Array, n_pred: np.ndarray, n_ref: np.ndarray, orders: Sequence[int]) -> Iterator[tuple]:
    """`(n, common, in prediction, in reference)` per text, for the words of all predictions and then of all references.

    An n-gram of a text has the number of its first n - 1 words and the code of its last one, so equal numbers are equal n-grams.
    """
    coded = pc.dictionary_encode(words, null_encoding="encode")
    code, n_codes = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    sizes = np.concatenate([n_pred, n_ref]).astype(np.int64)
    text = np.repeat(np.tile(np.arange(len(n_pred)), 2), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    at, ids = np.arange(len(code)), text
    for n in range(1, max(orders) + 1):
        inside = at + n <= end[at]
        at, ids = at[inside], ids[inside]
        _, ids = np.unique(ids * n_codes + code[at + n - 1], return_inverse=True)
        if n in orders:
            pred = at < n_pred.sum()
            distinct = int(ids.max(initial=-1)) + 1
            sides = [np.bincount(ids[side], minlength=distinct) for side in (pred, ~pred)]
            of = np.zeros(distinct, dtype=np.int64)
            of[ids] = text[at]
            common = np.bincount(of, weights=np.minimum(*sides), minlength=len(n_pred)).astype(np.int64)
            yield n, common, *[np.maximum(np.asarray(s, dtype=np.int64) - n + 1, 0) for s in (n_pred, n_ref)]


def f_measure(common: Column, n_pred: Column, n_ref: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * common, n_pred + n_ref), F.lit(0.0))


def rouge_lsum(predicted: Column, reference: Column) -> Column:
    """F measure of the united common subsequences of two arrays of sentences, each an array of words; 0 where either is empty."""
    n_words = lambda c: F.size(F.flatten(c))
    sizes = [F.when(side.isNull(), 0).otherwise(n_words(side)) for side in (predicted, reference)]
    return f_measure(fuzzy.sentence_hits(reference, predicted), *sizes)


def bleu(overlap: DataFrame, lengths: DataFrame, orders: int = 4) -> DataFrame:
    """Corpus BLEU from `ngram_overlap` rows; a zero precision makes the score zero.

    `lengths` is one row of `(hyp_len, ref_len)`.
    """
    precisions = overlap.groupBy("n").agg((100.0 * F.sum("common") / F.sum("n_pred")).alias("p"))
    logs = precisions.agg(
        F.sum(F.when(F.col("p") > 0, F.log("p"))).alias("log_sum"),
        F.min("p").alias("lowest"),
        F.count("*").alias("seen"),
        *[F.max(F.when(F.col("n") == n, F.col("p"))).alias(f"p{n}") for n in range(1, orders + 1)],
    )
    sizes = lengths.first()
    short = sizes["hyp_len"] < sizes["ref_len"]
    penalty = F.exp(1 - F.lit(sizes["ref_len"]) / F.lit(sizes["hyp_len"])) if short else F.lit(1.0)
    score = F.when((F.col("lowest") > 0) & (F.col("seen") == orders), penalty * F.exp(F.col("log_sum") / orders)).otherwise(0.0)
    return logs.select(score.alias("bleu"), penalty.alias("brevity_penalty"), *[f"p{n}" for n in range(1, orders + 1)])


def sequence_log_probability(logps: Column, prompt_length: int) -> Column:
    """Sum of the log probabilities after the prompt."""
    rest = F.slice(logps, prompt_length + 1, F.greatest(F.size(logps) - prompt_length, F.lit(0)))
    return F.aggregate(rest, F.lit(0.0), lambda s, x: s + x)


def cross_entropy(probabilities: Column, label: Column) -> Column:
    return -F.log(F.get(probabilities, label))


def answer_span(start: Column, end: Column, tokens: Column) -> Column:
    """Tokens from the likeliest start to the likeliest end; empty when they cross."""
    first = F.array_position(start, F.array_max(start)).cast("int")
    last = F.array_position(end, F.array_max(end)).cast("int")
    return F.slice(tokens, first, F.greatest(last - first + 1, F.lit(0)))


def distinct_ngram_share(words: Column, n: int) -> Column:
    """Distinct n-grams over all n-grams: 1 where nothing repeats."""
    return let(ngrams(words, n), lambda g: F.try_divide(F.size(F.array_distinct(g)).cast("double"), F.size(g)))
