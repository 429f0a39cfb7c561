"""Pooling of token vectors and document vectors from word vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.vectors import mean_vector


def masked_mean(tokens: DataFrame, key: str, vector: str, mask: Column, dims: int) -> DataFrame:
    """Mean of the unmasked token vectors of each text; the divisor is at least 1e-9."""
    return tokens.groupBy(key).agg(mean_vector(vector, dims, mask).alias("pooled"))


def last_token(tokens: DataFrame, key: str, vector: str, pos: str, mask: Column) -> DataFrame:
    """Vector of the last unmasked token, whichever side is padded."""
    return tokens.filter(mask == 1).groupBy(key).agg(F.max_by(vector, pos).alias("pooled"))


def first_token(tokens: DataFrame, key: str, vector: str, pos: str) -> DataFrame:
    return tokens.groupBy(key).agg(F.min_by(vector, pos).alias("pooled"))


def mean_and_max(layers: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """Per-dimension mean over the layers followed by the per-dimension maximum."""
    highest = F.array(*[F.max(F.col(vector)[i].cast("double")) for i in range(dims)])
    return layers.groupBy(key).agg(F.concat(mean_vector(vector, dims), highest).alias("pooled"))


def weighted_text_vectors(
    bags: DataFrame, keys: Sequence[str], weights: Sequence[str], vectors: DataFrame, dims: int
) -> DataFrame:
    """Mean word vector per key, once for each weight column of `bags(keys, word, weights)`.

    Words without a vector are left out.  The bags hold each word once per
    text, so a frequent word meets its vector once per text.
    """
    joined = bags.join(vectors, "word")
    means = [mean_vector("vec", dims, F.col(w)).alias(w) for w in weights]
    return joined.groupBy(*keys).agg(*means)


def coverage(counts: DataFrame, vectors: DataFrame) -> DataFrame:
    """How many words, and running words, have a vector."""
    known = vectors.select("word", F.lit(True).alias("known"))
    joined = counts.join(known, "word", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return joined.groupBy("known").agg(F.count("*").alias("words"), F.sum("n").alias("tokens"))


def principal_components(df: DataFrame, vector: str, k: int) -> DataFrame:
    """Projection on the first `k` principal components."""
    featured = df.withColumn("__v", array_to_vector(vector))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(featured)
    return model.transform(featured).withColumn("components", vector_to_array("__p")).drop("__v", "__p")
