"""Counts, histograms, frequencies, correlation and term weights."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], descending: bool = True) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n") if descending else F.asc("n"), *keys)


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Corpus frequency of each word; counted inside each task before the shuffle."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, words: Column, count: int) -> DataFrame:
    return word_counts(df, words).orderBy(F.desc("n"), "word").limit(count)


def characters(df: DataFrame, text: Column) -> DataFrame:
    """Every distinct character with its count; exploded characters are counted before any shuffle."""
    rows = df.select(F.explode(F.split(text, "")).alias("ch")).filter("ch <> ''")
    return rows.groupBy("ch").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, group: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin; bin 0 and bin `bins`+1 catch values outside."""
    bucket = F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.groupBy(*group, bucket.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def box_summary(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Five-number summary of an integer-valued column.

    Equal values are counted first; the percentile then works on the few
    distinct values with their counts.
    """
    counted = df.groupBy(*group, value).agg(F.count("*").alias("__n"))
    at = lambda p: F.percentile(F.col(value), p, F.col("__n"))
    return counted.groupBy(*group).agg(
        F.min(value).alias("low"),
        at(0.25).alias("q1"),
        at(0.5).alias("median"),
        at(0.75).alias("q3"),
        F.max(value).alias("high"),
        F.sum("__n").alias("n"),
    )


def approximate_summary(df: DataFrame, value: str, group: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """`box_summary` from a mergeable sketch, for real-valued columns."""
    cuts = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    summed = df.groupBy(*group).agg(F.min(value).alias("low"), cuts.alias("c"), F.max(value).alias("high"), F.count("*").alias("n"))
    parts = [F.get("c", F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    return summed.select(*group, "low", *parts, "high", "n")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of columns in one pass, as `(a, b, corr)` rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both_ways = sorted({(a, b) for a, b in pairs} | {(b, a) for a, b in pairs})
    name = lambda a, b: f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{name(a, b)}`").alias("corr")) for a, b in both_ways]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Surplus copies: rows minus distinct rows."""
    copies = df.groupBy(*columns).agg(F.count("*").alias("n"))
    return copies.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_duplicates"))


def document_frequency(df: DataFrame, words: Column) -> DataFrame:
    """Number of texts each word occurs in."""
    return word_counts(df, F.array_distinct(words)).withColumnRenamed("n", "df")


def rounded_idf(frequencies: DataFrame, documents: int | None = None) -> DataFrame:
    """round(log2(N / df)), half to even.

    N is the sum of document frequencies unless `documents` gives the standard count.
    """
    if documents is None:
        documents = frequencies.agg(F.sum("df")).first()[0]
    return frequencies.withColumn("idf", F.rint(F.log2(F.lit(documents) / F.col("df"))).cast("bigint"))


def vocabulary_filter(frequencies: DataFrame, documents: int, min_df: int, max_share: float, keep: int) -> DataFrame:
    """Words in at least `min_df` texts and at most a share of all, the `keep` most widespread."""
    kept = frequencies.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_share * documents)))
    return kept.orderBy(F.desc("df"), "word").limit(keep)


def bag_of_words(df: DataFrame, key: str, words: Column) -> DataFrame:
    rows = df.select(key, F.explode(words).alias("word"))
    return rows.groupBy(key, "word").agg(F.count("*").alias("tf"))


def class_word_counts(df: DataFrame, group: Sequence[str], words: Column) -> DataFrame:
    return df.select(*group, F.explode(words).alias("word")).groupBy(*group, "word").agg(F.count("*").alias("tf"))


def class_tf_idf(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Class TF-IDF of `counts(group, word, tf)`: a class is one long text.

    term share in the class times log(1 + average words per class / term count).
    `counts` is read three times and should be a stored table.
    """
    keys = list(group)
    sizes = counts.groupBy(*keys).agg(F.sum("tf").alias("class_words"))
    sizes = sizes.withColumn("avg_words", F.avg("class_words").over(Window.partitionBy()))  # one row per class
    overall = counts.groupBy("word").agg(F.sum("tf").alias("term_count"))
    score = F.col("tf") / F.col("class_words") * F.log(1 + F.col("avg_words") / F.col("term_count"))
    joined = counts.join(overall, "word").join(sizes, keys)
    return joined.withColumn("score", score).select(*keys, "word", "tf", "score")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], count: int, out: str = "rank") -> DataFrame:
    """First `count` rows of each group.

    Spark limits each group inside every map task before the shuffle, so a
    group with very many rows sends at most `count` rows per task.
    """
    spot = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(out, spot).filter(F.col(out) <= count)


def mean_word_length(words: Column) -> Column:
    letters = F.aggregate(words, F.lit(0), lambda acc, w: acc + F.length(w))
    return F.try_divide(letters.cast("double"), F.size(words))


def throughput(runs: DataFrame, group: str, tokens: str, seconds: str) -> DataFrame:
    """Tokens per second per group and overall (ratio of sums); failed runs are skipped."""
    done = runs.filter((F.col(seconds) > 0) & F.col(tokens).isNotNull())
    per = done.groupBy(group).agg(F.sum(tokens).alias("tokens"), F.sum(seconds).alias("seconds"))
    overall = per.agg(F.lit("all").alias(group), F.sum("tokens").alias("tokens"), F.sum("seconds").alias("seconds"))
    rate = F.round(F.col("tokens") / F.col("seconds"), 3).alias("tokens_per_second")
    return per.unionByName(overall).select(group, F.col("tokens").cast("bigint").alias("tokens"), rate)


def chunk_class(scores: DataFrame, key: str) -> DataFrame:
    """Mean class probability over the chunks of a text, and the best class."""
    means = scores.groupBy(key, "class").agg(F.avg("p").alias("p"))
    best = F.max_by(F.col("class"), F.struct("p", -F.col("class")))
    return means.groupBy(key).agg(best.alias("class"), F.max("p").alias("p"))


def corpus_offsets(df: DataFrame, group: str, order: str, text: Column, sep_len: int = 1) -> DataFrame:
    """Where each text starts and ends when the texts of a group are joined with a separator.

    Stands for the joined corpus text, which no single task could hold.
    """
    from textloom.operators.ordering import grouped_offset

    placed = grouped_offset(df, group, order, F.length(text) + sep_len, "start_char")
    return placed.withColumn("end_char", F.col("start_char") + F.length(text))
