"""Term weights, topic words and cluster labels."""

from pyspark.sql import functions as F

from textloom.functions import vectors as vc
from textloom.functions.hashing import hash_key
from textloom.functions.text import simple_tokens, words
from textloom.operators import models
from textloom.operators import statistics as st
from textloom.operators import topics as tp
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import query, r
from textloom.sources.scratch import durable

_SIMPLE_SQL = r"list_filter(regexp_extract_all(lower(text), '[\p{L}\p{M}_]+'), lambda x: length(x) BETWEEN 4 AND 15 AND x NOT LIKE '\_%' ESCAPE '\')"
_LOW = q.words("lower(text)")


@query(
    "a14_rounded_idf",
    f"""WITH {fx.VOCABULARY_SQL}, n AS (SELECT sum(df) AS n, (SELECT count(*) FROM documents) AS docs FROM vocab)
    SELECT word, df, round_even(log2(n::DOUBLE / df), 0)::BIGINT AS idf, round_even(log2(docs::DOUBLE / df), 0)::BIGINT AS standard_idf FROM vocab, n""",
)
def rounded_idf(t):
    frequencies = durable(fx.vocabulary(t))
    both = st.rounded_idf(frequencies).withColumnRenamed("idf", "first_idf")
    both = st.rounded_idf(both, documents=t.documents.count())
    return both.select("word", "df", F.col("first_idf").alias("idf"), F.col("idf").alias("standard_idf"))


@query(
    "a15_vocabulary_filter",
    f"""WITH d AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({_SIMPLE_SQL})) AS word FROM documents) GROUP BY word)
    SELECT word, df FROM d WHERE df >= 10 AND df <= 0.5 * (SELECT count(*) FROM documents) ORDER BY df DESC, word LIMIT 100000""",
)
def vocabulary_filter(t):
    frequencies = st.document_frequency(t.documents, simple_tokens(F.col("text")))
    return st.vocabulary_filter(frequencies, t.documents.count(), min_df=10, max_share=0.5, keep=100_000)


@query(
    "a16_bag_of_words",
    f"SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({_SIMPLE_SQL}) AS word FROM documents) GROUP BY ALL",
)
def bag_of_words(t):
    return st.bag_of_words(t.documents, "doc_id", simple_tokens(F.col("text")))


def _ctfidf_sql(name, keys, source):
    """Class TF-IDF of `source(keys, word)`."""
    join = " AND ".join(f"c.{k} = s.{k}" for k in keys)
    cols = ", ".join(keys)
    return f"""
{name}_c AS (SELECT {cols}, word, count(*) AS tf FROM {source} GROUP BY ALL),
{name}_s AS (SELECT {cols}, sum(tf) AS class_words FROM {name}_c GROUP BY ALL),
{name}_o AS (SELECT word, sum(tf) AS term_count FROM {name}_c GROUP BY word),
{name} AS (SELECT {', '.join('c.' + k for k in keys)}, c.word, c.tf, c.tf::DOUBLE / s.class_words * ln(1 + (SELECT avg(class_words) FROM {name}_s) / o.term_count) AS score
           FROM {name}_c c JOIN {name}_s s ON {join} JOIN {name}_o o ON o.word = c.word)"""


@query(
    "a17_class_tf_idf",
    f"""WITH w AS (SELECT source, unnest({_LOW}) AS word FROM documents), {_ctfidf_sql('ct', ['source'], 'w')}
    SELECT source, word, tf, {q.r('score', 8)} AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(score, 10) DESC, word)::INTEGER AS rank FROM ct) WHERE rank <= 10""",
)
def class_tf_idf(t):
    counts = durable(st.class_word_counts(t.documents, ["source"], words(F.lower("text"))))
    scored = st.class_tf_idf(counts, ["source"])
    top = st.top_per_group(scored, ["source"], [F.desc(F.round("score", 10)), F.col("word")], 10)
    return top.select("source", "word", "tf", r("score", 8).alias("score"), "rank")


@query(
    "a18_topics_over_time",
    f"""WITH w AS (SELECT lang AS topic, ((1995 + doc_id % 30 - 1995) // 3 + 1) AS bin, unnest({_LOW}) AS word FROM documents),
    {_ctfidf_sql('lo', ['topic', 'bin'], 'w')}, {_ctfidf_sql('gl', ['topic'], 'w')}
    SELECT topic, bin, word, {q.r('score', 8)} AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY topic, bin ORDER BY round(score, 10) DESC, word)::INTEGER AS rank FROM (
        SELECT lo.topic, lo.bin, lo.word, (lo.score + gl.score) / 2 AS score FROM lo JOIN gl ON gl.topic = lo.topic AND gl.word = lo.word)) WHERE rank <= 5""",
)
def topics_over_time(t):
    year = 1995 + F.col("doc_id") % 30
    dated = t.documents.select(F.col("lang").alias("topic"), tp.time_bin(year, 1995, 2025, 10).alias("bin"), "text")
    scored = tp.tuned_class_tf_idf(dated, "topic", ["bin"], words(F.lower("text")))
    top = st.top_per_group(scored, ["topic", "bin"], [F.desc(F.round("score", 10)), F.col("word")], 5)
    return top.select("topic", "bin", "word", r("score", 8).alias("score"), "rank")


@query(
    "a19_cluster_labels",
    f"""WITH {fx.VOCABULARY_SQL},
    idf AS (SELECT word, round_even(log2((SELECT sum(df) FROM vocab)::DOUBLE / df), 0)::BIGINT AS idf FROM vocab),
    tok AS (SELECT source, word, (['VERB', 'DOBJ', 'NOUN', 'ADJ'])[h % 4 + 1] AS pos FROM (
              SELECT source, word, {q.hash_key('word', 13)} AS h FROM (SELECT source, unnest({_LOW}) AS word FROM documents))),
    c AS (SELECT source, pos, word, count(*) AS n FROM tok GROUP BY ALL),
    r AS (SELECT source, pos, word, row_number() OVER (PARTITION BY source, pos ORDER BY CASE WHEN n > 1 THEN n * idf ELSE n END DESC, word) AS rank FROM c JOIN idf USING (word)),
    l AS (SELECT source, max(word) FILTER (pos = 'VERB' AND rank = 1) AS v, max(word) FILTER (pos = 'DOBJ' AND rank = 1) AS o,
                 max(word) FILTER (pos = 'NOUN' AND rank = 1) AS n1, max(word) FILTER (pos = 'NOUN' AND rank = 2) AS n2 FROM r GROUP BY source)
    SELECT source AS cluster, count(*) AS n, any_value(concat_ws('_', v, o, n1, n2)) AS label FROM documents JOIN l USING (source) GROUP BY source""",
)
def cluster_labels(t):
    """The part of speech of a word comes from its hash, in place of a tagger."""
    tokens = t.documents.select(F.col("source").alias("cluster"), F.explode(words(F.lower("text"))).alias("word"))
    kind = F.element_at(F.lit(["VERB", "DOBJ", "NOUN", "ADJ"]), (hash_key(F.col("word"), 13) % 4 + 1).cast("int"))
    labels = tp.cluster_labels(tokens, kind, st.rounded_idf(durable(fx.vocabulary(t))))
    sizes = t.documents.groupBy(F.col("source").alias("cluster")).agg(F.count("*").alias("n"))
    return sizes.join(labels, "cluster").select("cluster", "n", "label").orderBy(F.desc("n"), "cluster")


_SHARES_SQL = """
lg AS (SELECT vec_id AS doc_id, unnest(generate_series(0, 63)) AS idx, unnest(embedding)::DOUBLE * 10 AS x FROM embeddings),
sm AS (SELECT doc_id, idx, exp(x - mx) / sum(exp(x - mx)) OVER (PARTITION BY doc_id) AS p FROM (SELECT *, max(x) OVER (PARTITION BY doc_id) AS mx FROM lg)),
dt AS (SELECT doc_id, idx AS topic, p FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, idx) AS i FROM sm) WHERE i = 1)"""


@query(
    "m2_dominant_topic",
    f"""WITH {_SHARES_SQL}, w AS (SELECT doc_id % 64 AS topic, unnest({_LOW}) AS word FROM documents),
    c AS (SELECT topic, word, count(*) AS n FROM w GROUP BY ALL),
    k AS (SELECT topic, string_agg(word, ', ' ORDER BY rank) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) AS rank FROM c) WHERE rank <= 5 GROUP BY topic)
    SELECT d.doc_id, dt.topic::INTEGER AS topic, {q.r('p', 4)} AS contribution, keywords, array_to_string(({q.words('text')})[1:8], ' ') AS snippet
    FROM documents d JOIN dt ON dt.doc_id = d.doc_id JOIN k ON k.topic = dt.topic""",
)
def dominant_topic(t):
    """Topic shares come from the vectors; keywords from the texts of each topic."""
    logits = F.transform("embedding", lambda x: x.cast("double") * 10)
    shares = t.embeddings.select(F.col("vec_id").alias("doc_id"), vc.softmax(logits).alias("shares"))
    by_topic = t.documents.select((F.col("doc_id") % 64).alias("topic"), F.explode(words(F.lower("text"))).alias("word"))
    counts = by_topic.groupBy("topic", "word").agg(F.count("*").alias("n"))
    top = st.top_per_group(counts, ["topic"], [F.desc("n"), F.col("word")], 5)
    listed = F.array_sort(F.collect_list(F.struct("rank", "word")))
    keywords = top.groupBy(F.col("topic").cast("int").alias("topic")).agg(
        F.array_join(F.transform(listed, lambda s: s["word"]), ", ").alias("keywords")
    )
    best = models.dominant_topic(shares, "doc_id", F.col("shares"), keywords)
    snippet = t.documents.select("doc_id", F.array_join(F.slice(words(F.col("text")), 1, 8), " ").alias("snippet"))
    return best.join(snippet, "doc_id").select("doc_id", "topic", "contribution", "keywords", "snippet")
