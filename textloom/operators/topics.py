"""Topic words per class and time, and readable cluster names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.statistics import class_tf_idf, class_word_counts, top_per_group
from textloom.sources.scratch import durable


def time_bin(value: Column, low: int, high: int, bins: int) -> Column:
    return F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).cast("bigint")


def tuned_class_tf_idf(df: DataFrame, topic: str, within: Sequence[str], words: Column) -> DataFrame:
    """Class TF-IDF per topic and `within`, averaged with the topic's overall score."""
    counts = durable(class_word_counts(df, [topic, *within], words))
    local = class_tf_idf(counts, [topic, *within])
    by_topic = counts.groupBy(topic, "word").agg(F.sum("tf").alias("tf"))
    overall = class_tf_idf(by_topic, [topic]).select(topic, "word", F.col("score").alias("overall"))
    joined = local.join(overall, [topic, "word"])
    return joined.withColumn("score", (F.col("score") + F.col("overall")) / 2).drop("overall")


def cluster_labels(tokens: DataFrame, kind: Column, idf: DataFrame) -> DataFrame:
    """Name of each cluster: top verb, top object and two top nouns joined by `_`.

    `tokens` is `(cluster, word)`.  A word counted more than once weighs
    count * idf, otherwise its count; ties go to the earlier word.
    """
    counts = tokens.groupBy("cluster", "word").agg(F.count("*").alias("n")).withColumn("kind", kind)
    weight = F.when(F.col("n") > 1, F.col("n") * F.col("idf")).otherwise(F.col("n"))
    weighed = counts.filter(F.col("kind").isin("VERB", "DOBJ", "NOUN")).join(idf.select("word", "idf"), "word")
    best = top_per_group(
        weighed.withColumn("weight", weight), ["cluster", "kind"], [F.desc("weight"), F.col("word")], 2
    )
    pick = lambda k, rank: F.max(F.when((F.col("kind") == k) & (F.col("rank") == rank), F.col("word")))
    chosen = best.groupBy("cluster").agg(
        pick("VERB", 1).alias("verb"), pick("DOBJ", 1).alias("dobj"), pick("NOUN", 1).alias("n1"), pick("NOUN", 2).alias("n2")
    )
    lead = F.array_compact(F.array("verb", "dobj"))
    nouns = F.array_except(F.array_compact(F.array("n1", "n2")), lead)
    return chosen.select("cluster", F.array_join(F.concat(lead, nouns), "_").alias("label"))
