"""Pooling, similarity and scaling of vectors."""

from pyspark.sql import functions as F

from textloom.functions import vectors as vc
from textloom.functions.text import words
from textloom.operators import pooling
from textloom.operators import statistics as st
from textloom.operators.models import sweep_cost
from textloom.operators.prompts import turn_pairs
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import query, r
from textloom.sources.scratch import durable

TOKENS_SQL = """
tv AS (SELECT vec_id // 8 AS doc_id, vec_id % 8 AS pos, (vec_id % 8 < 3 + (vec_id // 8) % 6)::INTEGER AS mask, embedding FROM embeddings)"""


def token_vectors(t):
    """Eight consecutive vectors are the tokens of one text; the last ones may be padding."""
    doc = F.expr("vec_id div 8")
    return t.embeddings.select(
        doc.alias("doc_id"),
        (F.col("vec_id") % 8).alias("pos"),
        (F.col("vec_id") % 8 < 3 + doc % 6).cast("int").alias("mask"),
        "embedding",
    )


def _long(df, key, column="pooled"):
    rows = df.select(key, F.posexplode(column).alias("dim", "value"))
    return rows.select(key, "dim", r(F.col("value").cast("double")).alias("value"))


@query(
    "v1_masked_mean",
    f"""WITH {TOKENS_SQL}, l AS (SELECT doc_id, mask, unnest(generate_series(0, 63)) AS dim, unnest(embedding)::DOUBLE AS v FROM tv)
    SELECT doc_id, dim::INTEGER AS dim, {q.r('sum(v * mask) / greatest(sum(mask), 1e-9::DOUBLE)')} AS value FROM l GROUP BY doc_id, dim""",
)
def masked_mean(t):
    return _long(pooling.masked_mean(token_vectors(t), "doc_id", "embedding", F.col("mask"), fx.DIMS), "doc_id")


@query(
    "v2_last_token",
    f"""WITH {TOKENS_SQL}, l AS (SELECT doc_id, arg_max(embedding, pos) AS e FROM tv WHERE mask = 1 GROUP BY doc_id)
    SELECT doc_id, dim::INTEGER AS dim, {q.r('v')} AS value FROM (SELECT doc_id, unnest(generate_series(0, 63)) AS dim, unnest(e)::DOUBLE AS v FROM l)""",
)
def last_token(t):
    return _long(pooling.last_token(token_vectors(t), "doc_id", "embedding", "pos", F.col("mask")), "doc_id")


@query(
    "v3_first_token",
    f"""WITH {TOKENS_SQL} SELECT doc_id, dim::INTEGER AS dim, {q.r('v')} AS value FROM (
      SELECT doc_id, unnest(generate_series(0, 63)) AS dim, unnest(embedding)::DOUBLE AS v FROM tv WHERE pos = 0)""",
)
def first_token(t):
    return _long(pooling.first_token(token_vectors(t), "doc_id", "embedding", "pos"), "doc_id")


@query(
    "v3_mean_and_max",
    f"""WITH {TOKENS_SQL}, l AS (SELECT doc_id, unnest(generate_series(0, 63)) AS dim, unnest(embedding)::DOUBLE AS v FROM tv)
    SELECT doc_id, dim::INTEGER AS dim, {q.r('avg(v)')} AS value FROM l GROUP BY doc_id, dim
    UNION ALL SELECT doc_id, (dim + 64)::INTEGER, {q.r('max(v)')} FROM l GROUP BY doc_id, dim""",
)
def mean_and_max(t):
    return _long(pooling.mean_and_max(token_vectors(t), "doc_id", "embedding", fx.DIMS), "doc_id")


def _pair_bags(t):
    """Each word of a pair once, with its count on either side."""
    pairs = turn_pairs(t.conversations)
    sides = F.flatten(
        F.array(
            F.transform(words(F.lower("question")), lambda w: F.struct(w.alias("word"), F.lit(1).alias("q"), F.lit(0).alias("a"))),
            F.transform(words(F.lower("answer")), lambda w: F.struct(w.alias("word"), F.lit(0).alias("q"), F.lit(1).alias("a"))),
        )
    )
    rows = pairs.select("conv_id", "pair_turn", F.explode(sides).alias("s")).select("conv_id", "pair_turn", "s.*")
    return rows.groupBy("conv_id", "pair_turn", "word").agg(F.sum("q").alias("q"), F.sum("a").alias("a"))


def _cosine_sql(condition):
    return f"""
    SELECT conv_id, pair_turn, CASE WHEN count(*) > 0 THEN sum(q * a) / sqrt(sum(q * q)) / sqrt(sum(a * a)) END AS c FROM (
      SELECT conv_id, pair_turn, dim, sum(v) FILTER (side = 'q') / greatest(count(*) FILTER (side = 'q'), 1) AS q,
             sum(v) FILTER (side = 'a') / greatest(count(*) FILTER (side = 'a'), 1) AS a FROM (
        SELECT conv_id, pair_turn, side, unnest(generate_series(0, 63)) AS dim, unnest(vec)::DOUBLE AS v
        FROM w JOIN wv USING (word) WHERE {condition}) GROUP BY conv_id, pair_turn, dim) GROUP BY conv_id, pair_turn"""


@query(
    "v4_text_similarity",
    f"""WITH {q.PAIRS}, {fx.WORD_VECTORS_SQL}, stop AS (SELECT word FROM vocab ORDER BY df DESC, word LIMIT 50),
    w AS (SELECT conv_id, pair_turn, 'q' AS side, unnest({q.words('lower(question)')}) AS word FROM pairs
          UNION ALL SELECT conv_id, pair_turn, 'a', unnest({q.words('lower(answer)')}) FROM pairs),
    c1 AS ({_cosine_sql('true')}), c2 AS ({_cosine_sql('word NOT IN (SELECT word FROM stop)')})
    SELECT 'all words' AS words_used, conv_id, pair_turn, {q.r('c')} AS cosine FROM c1 WHERE c IS NOT NULL
    UNION ALL SELECT 'no stop words', conv_id, pair_turn, {q.r('c')} FROM c2 WHERE c IS NOT NULL""",
)
def text_similarity(t):
    bags, vectors = _pair_bags(t), durable(fx.word_vectors(t))
    lean = bags.join(fx.stop_words(t).select("word"), "word", "left_anti")

    def score(rows, name):
        pooled = pooling.weighted_text_vectors(rows, ["conv_id", "pair_turn"], ["q", "a"], vectors, fx.DIMS)
        cosine = r(vc.cosine(F.col("q"), F.col("a"))).alias("cosine")
        return pooled.select(F.lit(name).alias("words_used"), "conv_id", "pair_turn", cosine).dropna()

    return score(bags, "all words").unionByName(score(lean, "no stop words"))


@query(
    "v5_vector_coverage",
    f"""WITH {fx.WORD_VECTORS_SQL}, c AS (SELECT word, count(*) AS n FROM (SELECT unnest({q.words('lower(text)')}) AS word FROM documents) GROUP BY word)
    SELECT vec IS NOT NULL AS known, count(*) AS words, sum(n)::BIGINT AS tokens FROM c LEFT JOIN wv USING (word) GROUP BY 1""",
)
def vector_coverage(t):
    return pooling.coverage(st.word_counts(t.documents, words(F.lower("text"))), fx.word_vectors(t))


@query("v6_principal_components")
def principal_components(t):
    reduced = pooling.principal_components(t.embeddings, "embedding", 2)
    return reduced.select("vec_id", r(F.col("components")[0]).alias("x"), r(F.col("components")[1]).alias("y"))


@query(
    "v7_unit_scale",
    f"""SELECT vec_id, dim::INTEGER AS dim, {q.r('(v - lo) / (hi - lo)')} AS value FROM (
      SELECT vec_id, unnest(generate_series(0, 63)) AS dim, unnest(embedding)::DOUBLE AS v, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings)""",
)
def unit_scale(t):
    return _long(t.embeddings.select("vec_id", vc.scale_unit(F.col("embedding")).alias("pooled")), "vec_id")


@query(
    "v8_sweep_cost",
    f"""WITH m AS (SELECT run, (vec_id % run) AS cluster, abs(embedding[run]::DOUBLE) AS p FROM embeddings, (SELECT unnest([2, 5, 12, 20]) AS run)),
    s AS (SELECT run, count(DISTINCT cluster) AS label_count, avg((p < 0.05)::INTEGER) AS cost FROM m GROUP BY run)
    SELECT run, label_count, {q.r('cost')} AS cost, {q.r('cost + CASE WHEN label_count < 4 OR label_count > 15 THEN 1 ELSE 0 END')} AS loss FROM s""",
)
def sweep_costs(t):
    runs = F.array(*[F.lit(k) for k in (2, 5, 12, 20)])
    members = t.embeddings.select("vec_id", "embedding", F.explode(runs).alias("run")).select(
        "run", (F.col("vec_id") % F.col("run")).alias("cluster"), F.abs(F.element_at("embedding", F.col("run")).cast("double")).alias("p")
    )
    costs = sweep_cost(members, "run", "cluster", "p", 4, 15)
    return costs.select("run", "label_count", r("cost").alias("cost"), r("loss").alias("loss"))


@query(
    "v9_cluster_members",
    """WITH c AS (SELECT vec_id, CASE WHEN abs(embedding[1]) < 0.02::FLOAT THEN -1 ELSE label END AS cluster FROM embeddings)
    SELECT cluster, vec_id, count(*) OVER (PARTITION BY cluster) AS n FROM c""",
)
def cluster_members(t):
    cluster = F.when(F.abs(F.element_at("embedding", 1)) < F.lit(0.02).cast("float"), -1).otherwise(F.col("label"))
    members = t.embeddings.select("vec_id", cluster.alias("cluster"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"))
    return members.join(sizes, "cluster").select("cluster", "vec_id", "n")
