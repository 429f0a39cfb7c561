"""Projections, filters, sorts, limits and set operations."""

from pyspark.sql import functions as F

from textloom.functions.hashing import hash_key
from textloom.functions.text import space_parts, word_count, words
from textloom.operators import splits, tables
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query
from textloom.sources.writers import length_ordered

SEED = 42


@query("f1_select_rename", "SELECT event_id, event_type AS label, value AS score FROM events")
def select_rename(t):
    return t.events.drop("ts", "user_id", "props").withColumnsRenamed({"event_type": "label", "value": "score"})


@query(
    "f2_null_report",
    """
    WITH j AS (SELECT d.doc_id, d.text, l.quality, CASE WHEN l.toxic = 1 THEN 1 END AS toxic
               FROM documents d LEFT JOIN labels l USING (doc_id)),
    n AS (SELECT count(*) AS rows_before,
                 count(*) FILTER (doc_id IS NOT NULL AND text IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL) AS rows_after,
                 count(*) FILTER (doc_id IS NULL) AS a, count(*) FILTER (text IS NULL) AS b,
                 count(*) FILTER (quality IS NULL) AS c, count(*) FILTER (toxic IS NULL) AS d FROM j)
    SELECT 'doc_id' AS "column", a AS nulls_before, 0::BIGINT AS nulls_after, rows_before, rows_after FROM n
    UNION ALL SELECT 'text', b, 0, rows_before, rows_after FROM n
    UNION ALL SELECT 'quality', c, 0, rows_before, rows_after FROM n
    UNION ALL SELECT 'toxic', d, 0, rows_before, rows_after FROM n
    """,
)
def null_report(t):
    joined = t.documents.join(t.labels, "doc_id", "left").withColumn("toxic", F.when(F.col("toxic") == 1, 1))
    return tables.null_report(joined, ["doc_id", "text", "quality", "toxic"])


@query(
    "f4_drop_placeholders",
    """
    SELECT doc_id, trim(body) AS body FROM (
      SELECT d.doc_id, CASE WHEN l.quality = 0 THEN '  Early Access Review ' WHEN l.toxic = 1 THEN 'nan' ELSE d.text END AS body
      FROM documents d LEFT JOIN labels l USING (doc_id))
    WHERE trim(body) NOT IN ('Early Access Review', 'nan')
    """,
)
def drop_placeholders(t):
    body = (
        F.when(F.col("quality") == 0, "  Early Access Review ").when(F.col("toxic") == 1, "nan").otherwise(F.col("text"))
    )
    reviews = t.documents.join(t.labels, "doc_id", "left").select("doc_id", body.alias("body"))
    return tables.drop_placeholders(reviews, "body", ["Early Access Review", "nan"])


@query(
    "f5_recode",
    """
    SELECT doc_id, CASE WHEN 2 * quality - 1 = -1 THEN 0 ELSE 2 * quality - 1 END AS review_score,
           CASE WHEN stars BETWEEN 1 AND 5 THEN (stars - 1)::VARCHAR END AS star_class
    FROM (SELECT doc_id, quality, 1 + doc_id % 6 AS stars FROM labels)
    """,
)
def recode(t):
    score, stars = 2 * F.col("quality") - 1, 1 + F.col("doc_id") % 6
    return t.labels.select(
        "doc_id",
        tables.recode(score, {-1: 0}, other=score).alias("review_score"),
        tables.recode(stars, {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}).cast("string").alias("star_class"),
    )


@query("f6_membership", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de') AND doc_id IN (SELECT doc_id FROM labels)")
def membership(t):
    listed = t.documents.select("doc_id", "lang").filter(F.col("lang").isin("en", "de"))
    return listed.join(t.labels, "doc_id", "left_semi")


@query(
    "f7_text_concat",
    """
    SELECT doc_id, text || ' ' || quality AS with_null, 'Prompt: ' || lang || ' Completion: ' || text AS flat
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def text_concat(t):
    joined = t.documents.join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        F.concat("text", F.lit(" "), F.col("quality").cast("string")).alias("with_null"),
        F.concat(F.lit("Prompt: "), "lang", F.lit(" Completion: "), "text").alias("flat"),
    )


@query(
    "f8_constant_class",
    """
    SELECT doc_id, text, source, 1 AS news_class FROM documents WHERE lang = 'en'
    UNION ALL SELECT doc_id, text, source, 0 FROM documents WHERE lang <> 'en'
    """,
)
def constant_class(t):
    news = t.documents.select("doc_id", "text", "source", "lang")
    parts = {1: news.filter("lang = 'en'").drop("lang"), 0: news.filter("lang <> 'en'").drop("lang")}
    return tables.union_with_class(parts, "news_class")


@query(
    "f9_lengths",
    f"""
    SELECT doc_id, {q.word_count('text')}::INTEGER AS n_words, len(string_split(text, ' '))::INTEGER AS n_parts,
           length(text)::INTEGER AS n_chars FROM documents
    """,
)
def lengths(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id", word_count(text).alias("n_words"), F.size(space_parts(text)).alias("n_parts"), F.length(text).alias("n_chars")
    )


@query(
    "f10_length_mismatch",
    f"""
    SELECT doc_id, n_words, n_parts FROM (
      SELECT doc_id, {q.word_count('text')}::INTEGER AS n_words, len(string_split(text, ' '))::INTEGER AS n_parts FROM documents)
    WHERE n_words <> n_parts
    """,
)
def length_mismatch(t):
    text = F.col("text")
    counted = t.documents.select("doc_id", word_count(text).alias("n_words"), F.size(space_parts(text)).alias("n_parts"))
    return counted.filter("n_words <> n_parts")


@query(
    "f11_clip",
    f"SELECT doc_id, substr(text, 1, 2000) AS clipped, {q.csv(q.words('text') + '[1:8]')} AS snippet FROM documents",
)
def clip(t):
    """The reference's own previews: a 2 000 character prefix and the first eight words."""
    text = F.col("text")
    return t.documents.select(
        "doc_id", F.substring(text, 1, 2000).alias("clipped"), csv(F.slice(words(text), 1, 8)).alias("snippet")
    )


_REFERENCE_SQL = """
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Phys. Lett. (in press)' WHEN doc_id % 11 = 0 THEN NULL
                        ELSE source || ' vol. ' || (doc_id % 30) || ', ' || (1995 + doc_id % 30) END AS reference
    FROM documents"""


@query(
    "f12_year_window",
    f"""
    SELECT doc_id, y AS year FROM (SELECT doc_id, try_cast(right(reference, 4) AS INTEGER) AS y FROM ({_REFERENCE_SQL}))
    WHERE y > 2000 AND y <= 2021
    """,
)
def year_window(t):
    number = F.col("doc_id")
    reference = (
        F.when(number % 7 == 0, "Phys. Lett. (in press)")
        .when(number % 11 == 0, F.lit(None))
        .otherwise(F.concat("source", F.lit(" vol. "), number % 30, F.lit(", "), 1995 + number % 30))
    )
    dated = t.documents.select("doc_id", tables.publication_year(reference).alias("year"))
    return dated.filter("year > 2000 AND year <= 2021")


@query(
    "f13_first_category",
    """
    SELECT doc_id, split_part(lang || ' ' || source, ' ', 1) AS code, name FROM documents
    JOIN (VALUES ('en', 'English'), ('fr', 'French'), ('de', 'German')) AS n(code, name) ON n.code = lang
    """,
)
def first_category(t):
    names = t.spark.createDataFrame([("en", "English"), ("fr", "French"), ("de", "German")], "code string, name string")
    found = tables.first_category(t.documents, F.concat_ws(" ", "lang", "source"), names)
    return found.select("doc_id", "code", "name")


@query("o1_hardest_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def hardest_rows(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("o2_length_layout", f"SELECT doc_id, {q.word_count('text')}::INTEGER AS n_words FROM documents")
def length_layout(t):
    """Rows laid out by length; the oracle compares the rows, the tests the order."""
    counted = t.documents.select("doc_id", word_count(F.col("text")).alias("n_words"))
    return length_ordered(counted, F.col("n_words"))


@query(
    "o3_exact_sample",
    f"SELECT doc_id, source FROM documents ORDER BY {q.hash_key('doc_id', 1234)}, doc_id LIMIT 100",
)
def exact_sample(t):
    return splits.exact_sample(t.documents.select("doc_id", "source"), "doc_id", 100, seed=1234)


@query(
    "u1_union_all",
    "SELECT item_id AS id, text FROM benchmark UNION ALL SELECT doc_id, text FROM documents",
)
def union_all(t):
    return t.benchmark.withColumnRenamed("item_id", "id").unionByName(t.documents.select(F.col("doc_id").alias("id"), "text"))


@query(
    "u2_split_union",
    f"""
    WITH c AS (
      SELECT 'doc' || doc_id AS id, CASE WHEN {q.hash_key('doc_id', SEED)} < {int(0.9 * (1 << 28))} THEN 'train' ELSE 'test' END AS split FROM documents
      UNION ALL
      SELECT 'page' || page_id, CASE WHEN {q.hash_key('page_id', SEED)} < {int(0.9 * (1 << 28))} THEN 'train' ELSE 'test' END FROM pages)
    SELECT id, split, {q.hash_key('id', SEED)} AS place FROM c
    """,
)
def split_union(t):
    shares = {"train": 0.9, "test": 0.1}
    docs = splits.ratio_split(t.documents, "doc_id", shares, SEED).select(F.concat(F.lit("doc"), "doc_id").alias("id"), "split")
    pages = splits.ratio_split(t.pages, "page_id", shares, SEED).select(F.concat(F.lit("page"), "page_id").alias("id"), "split")
    both = docs.unionByName(pages).withColumn("place", hash_key(F.col("id"), SEED))
    return both.repartitionByRange("split", "place").sortWithinPartitions("split", "place")


@query(
    "u3_drop_duplicates",
    "SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY text, lang",
)
def drop_duplicates(t):
    return tables.distinct_by(t.documents.select("text", "lang", "doc_id"), ["text", "lang"], "doc_id")


@query(
    "u4_word_sets",
    f"""
    WITH {q.PAIRS}
    SELECT conv_id, pair_turn,
           len(list_intersect(list_distinct({q.words('question')}), list_distinct({q.words('answer')})))::INTEGER AS shared,
           (len(list_distinct({q.words('question')})) - len(list_intersect(list_distinct({q.words('question')}), list_distinct({q.words('answer')}))))::INTEGER AS only_question
    FROM pairs
    """,
)
def word_sets(t):
    from textloom.operators.prompts import turn_pairs

    both, left = tables.word_set_overlap(F.col("question"), F.col("answer"))
    pairs = turn_pairs(t.conversations)
    return pairs.select("conv_id", "pair_turn", F.size(both).alias("shared"), F.size(left).alias("only_question"))
