"""Aggregations over labels, words and texts."""

from pyspark.sql import functions as F

from textloom.functions.text import lower_collapsed, strip_digits, strip_punctuation, word_count, words
from textloom.operators import sketches
from textloom.operators import statistics as st
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import query, r
from textloom.sources.scratch import durable

CLEAN = q.strip(q.strip("lower(text)", r"[^\p{L}\p{M}\p{N}_" + q.SPACE + "]"), r"\p{Nd}+")


@query("a1_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(t):
    return st.value_counts(t.events, ["event_type"])


@query(
    "a2_fold_class_counts",
    f"""SELECT ({q.hash_key('text', 5)} % 5)::INTEGER AS fold, quality, count(*) AS n
        FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""",
)
def fold_class_counts(t):
    from textloom.operators.splits import group_folds

    return st.value_counts(group_folds(t.documents.join(t.labels, "doc_id"), "text", 5, seed=5), ["fold", "quality"])


@query("a3_group_mean_length", f"SELECT source, {q.r('avg(' + q.word_count('text') + ')')} AS mean_words FROM documents GROUP BY 1")
def group_mean_length(t):
    means = t.documents.groupBy("source").agg(r(F.avg(word_count(F.col("text")))).alias("mean_words"))
    return means.orderBy("mean_words", "source")


@query(
    "a4_shape_and_distinct",
    "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds, 6::BIGINT AS n_columns FROM events",
)
def shape_and_distinct(t):
    return t.events.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("event_type").alias("kinds"),
    ).withColumn("n_columns", F.lit(len(t.events.columns)).cast("bigint"))


@query(
    "a5_duplicate_count",
    "SELECT count(*) AS n_rows, count(*) - count(DISTINCT (text, lang)) AS n_duplicates FROM documents",
)
def duplicate_count(t):
    return st.duplicate_count(t.documents, ["text", "lang"])


@query(
    "a6_word_frequency",
    f"""
    WITH b AS (SELECT unnest({q.words('text')}) AS word FROM documents),
         a AS (SELECT unnest({q.words(CLEAN)}) AS word FROM documents)
    (SELECT 'before' AS stage, word, count(*) AS n FROM b GROUP BY word ORDER BY n DESC, word LIMIT 200)
    UNION ALL (SELECT 'after', word, count(*) AS n FROM a GROUP BY word ORDER BY n DESC, word LIMIT 200)
    """,
)
def word_frequency(t):
    text = F.col("text")
    before = st.top_words(t.documents, words(text), 200).withColumn("stage", F.lit("before"))
    cleaned = strip_digits(strip_punctuation(F.lower(text)))
    return before.unionByName(st.top_words(t.documents, words(cleaned), 200).withColumn("stage", F.lit("after")))


@query(
    "a7_json_key_frequency",
    """
    SELECT k.key AS key, json_extract_string(props, '$.' || k.key) AS value, count(*) AS n
    FROM events, (SELECT unnest(['k']) AS key) k WHERE json_extract_string(props, '$.' || k.key) IS NOT NULL
    GROUP BY ALL ORDER BY n DESC, value LIMIT 10
    """,
)
def json_key_frequency(t):
    pairs = t.events.select(F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return pairs.groupBy("key", "value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(10)


@query(
    "a8_character_inventory",
    f"""
    SELECT stage, ch, count(*) AS n FROM (
      SELECT 'before' AS stage, unnest(string_split(text, '')) AS ch FROM documents
      UNION ALL SELECT 'after', unnest(string_split({CLEAN}, '')) FROM documents) WHERE ch <> '' GROUP BY ALL
    """,
)
def character_inventory(t):
    text = F.col("text")
    before = st.characters(t.documents, text).withColumn("stage", F.lit("before"))
    after = st.characters(t.documents, strip_digits(strip_punctuation(F.lower(text)))).withColumn("stage", F.lit("after"))
    return before.unionByName(after).orderBy("stage", "ch")


@query(
    "a9_corpus_offsets",
    """
    SELECT source, doc_id, e - length(text) - 1 AS start_char, e - 1 AS end_char FROM (
      SELECT source, doc_id, text, sum(length(text) + 1) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS e FROM documents)
    """,
)
def corpus_offsets(t):
    placed = st.corpus_offsets(t.documents, "source", "doc_id", F.col("text"))
    return placed.select("source", "doc_id", "start_char", "end_char")


@query(
    "a10_length_histogram",
    f"""
    SELECT lang, bin, count(*) AS n FROM (
      SELECT lang, CASE WHEN n < 0 THEN 0 WHEN n >= 1000 THEN 21 ELSE n // 50 + 1 END AS bin
      FROM (SELECT lang, {q.word_count('text')} AS n FROM documents)) GROUP BY ALL
    """,
)
def length_histogram(t):
    counted = t.documents.select("lang", word_count(F.col("text")).alias("n_words"))
    return st.histogram(counted, "n_words", 0, 1000, 20, group=["lang"])


@query(
    "a10_box_summary",
    f"""
    SELECT lang, min(n)::INTEGER AS low, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median,
           quantile_cont(n, 0.75) AS q3, max(n)::INTEGER AS high, count(*) AS n
    FROM (SELECT lang, {q.word_count('text')} AS n FROM documents) GROUP BY lang
    """,
)
def box_summary(t):
    counted = t.documents.select("lang", word_count(F.col("text")).alias("n_words"))
    return st.box_summary(counted, "n_words", group=["lang"])


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a11_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {q.r(f'corr({a}, {b})')} AS corr FROM lineitem" for a in _NUM for b in _NUM
    ),
)
def correlation_matrix(t):
    return st.correlations(t.lineitem, _NUM).select("a", "b", r("corr").alias("corr"))


@query(
    "a12_entity_counts",
    f"""
    WITH {fx.GAZETTEER_SQL},
    m AS (SELECT unnest({q.words('lower(text)')}) AS word FROM documents),
    c AS (SELECT type, word, count(*) AS n FROM m JOIN gaz USING (word) GROUP BY ALL HAVING count(*) > 1)
    SELECT * FROM (SELECT type, word, n, row_number() OVER (PARTITION BY type ORDER BY n DESC, word)::INTEGER AS rank FROM c) WHERE rank <= 10
    """,
)
def entity_counts(t):
    """Words are counted before they meet the gazetteer, so the join sees each word once."""
    counts = st.word_counts(t.documents, words(F.lower("text")))
    named = counts.join(fx.gazetteer(t), "word").filter("n > 1").select("type", "word", "n")
    return st.top_per_group(named, ["type"], [F.desc("n"), F.col("word")], 10)


@query(
    "a13_entity_per_split",
    f"""
    WITH {fx.SPANS_SQL},
    s AS (SELECT CASE WHEN {q.hash_key('doc_id', 42)} < {int(0.8 * (1 << 28))} THEN 'train' ELSE 'test' END AS split, class FROM gold)
    SELECT split, {', '.join(f"""count(*) FILTER (class = '{c}') AS "{c}" """ for c in fx.CLASSES)} FROM s GROUP BY split
    """,
)
def entity_per_split(t):
    from textloom.operators.labels import bio_tags
    from textloom.operators.splits import ratio_split

    sizes = fx.doc_words(t).select("doc_id", F.size("words").alias("n_words"))
    tags = bio_tags(sizes, fx.gold_spans(t), "doc_id", fx.text_parts(t)).filter(F.col("tag").startswith("B-"))
    named = tags.withColumn("class", F.substring_index("tag", "-", -1))
    split = ratio_split(named, "doc_id", {"train": 0.8, "test": 0.2}, 42)
    return split.groupBy("split").pivot("class", fx.CLASSES).agg(F.count("tag"))


@query(
    "a20_chunk_class",
    f"""
    WITH p AS (SELECT vec_id // 4 AS doc_id, c AS class, abs(embedding[c + 1]::DOUBLE) AS p
               FROM embeddings, (SELECT unnest([0, 1, 2]) AS c)),
    m AS (SELECT doc_id, class, avg(p) AS p FROM p GROUP BY ALL)
    SELECT doc_id, class, {q.r('p')} AS p FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, class) AS i FROM m) WHERE i = 1
    """,
)
def chunk_class(t):
    """Four consecutive vectors stand for the chunk scores of one text."""
    rows = t.embeddings.select(
        F.expr("vec_id div 4").alias("doc_id"), F.posexplode(F.slice("embedding", 1, 3)).alias("class", "v")
    )
    best = st.chunk_class(rows.withColumn("p", F.abs(F.col("v").cast("double"))), "doc_id")
    return best.select("doc_id", "class", r("p").alias("p"))


@query(
    "a21_throughput",
    f"""
    WITH d AS (SELECT event_type, (event_id % 500) AS tokens, value FROM events WHERE value > 0 AND event_type <> 'error')
    SELECT event_type, sum(tokens)::BIGINT AS tokens, {q.r('sum(tokens) / sum(value)', 3)} AS tokens_per_second FROM d GROUP BY 1
    UNION ALL SELECT 'all', sum(tokens)::BIGINT, {q.r('sum(tokens) / sum(value)', 3)} FROM d
    """,
)
def throughput(t):
    """Events as a run log; error events are failed prompts."""
    tokens = F.when(F.col("event_type") != "error", F.col("event_id") % 500)
    return st.throughput(t.events.withColumn("tokens", tokens), "event_type", "tokens", "value")


@query(
    "a22_column_report",
    f"""
    WITH j AS (SELECT d.doc_id, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'quality' AS "column", sum(quality)::DOUBLE AS total, {q.r('avg((quality IS NULL)::INTEGER)')} AS missing FROM j
    UNION ALL SELECT 'n_words', sum({q.word_count('text')})::DOUBLE, {q.r('avg((text IS NULL)::INTEGER)')} FROM j
    """,
)
def column_report(t):
    joined = t.documents.join(t.labels, "doc_id", "left").select("quality", word_count(F.col("text")).alias("n_words"))
    names = ["quality", "n_words"]
    sums = [F.sum(c).cast("double").alias(f"total_{c}") for c in names]
    gaps = [F.avg(F.col(c).isNull().cast("int")).alias(f"gap_{c}") for c in names]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"total_{c}").alias("total"), r(f"gap_{c}").alias("missing")) for c in names]
    return joined.agg(*sums, *gaps).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query(
    "a24_mean_word_length",
    f"""
    SELECT quality, bin, count(*) AS n FROM (
      SELECT quality, CASE WHEN m < 0 THEN 0 WHEN m >= 12 THEN 25 ELSE (floor(m / 0.5) + 1)::BIGINT END AS bin FROM (
        SELECT quality, list_sum(list_transform(w, lambda x: length(x)))::DOUBLE / len(w) AS m
        FROM (SELECT quality, {q.words('text')} AS w FROM documents JOIN labels USING (doc_id)) WHERE len(w) > 0))
    GROUP BY ALL
    """,
)
def mean_word_length(t):
    labelled = t.documents.join(t.labels, "doc_id")
    means = labelled.select("quality", st.mean_word_length(words(F.col("text"))).alias("mean_length"))
    return st.histogram(means.dropna(), "mean_length", 0, 12, 24, group=["quality"])


def _word_sketches(t):
    """Stored sketches of the words of each source and language."""
    rows = t.documents.select("source", "lang", F.explode(words(F.col("text"))).alias("word"))
    return durable(sketches.sketched(rows, ["source", "lang"], "word"))


@query("a23_sketch_counts")
def sketch_counts(t):
    """Distinct words of each source and language, then of each source and of all, merged from the stored sketches."""
    stored = _word_sketches(t)
    by_source = sketches.merged(stored, ["source"])
    levels = [
        sketches.distinct_counts(stored, ["source", "lang"]).withColumn("level", F.lit("source, lang")),
        sketches.distinct_counts(by_source, ["source"]).withColumn("level", F.lit("source")),
        sketches.distinct_counts(sketches.merged(stored, []), []).withColumn("level", F.lit("all")),
    ]
    every = levels[0].unionByName(levels[1], allowMissingColumns=True).unionByName(levels[2], allowMissingColumns=True)
    return every.select("level", "source", "lang", F.col("n").alias("n_words"), "approx_distinct")


@query("a23_frequent_words")
def frequent_words(t):
    """The twenty most frequent words of each source, from merged sketches."""
    return sketches.frequent_values(sketches.merged(_word_sketches(t), ["source"]), ["source"], 20)
