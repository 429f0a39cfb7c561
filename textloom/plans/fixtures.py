"""Inputs that the given tables do not hold directly, derived by fixed rules."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from textloom.functions.hashing import hash_key
from textloom.functions.text import WORD, words
from textloom.operators.joins import RANGE_BUCKET, arrow_lists, bundled, list_array, list_values, pairs_inside, texts_of
from textloom.operators.labels import word_offsets
from textloom.operators.ordering import by_key, parts_for
from textloom.plans import sqltext as q

# Span classes.
CLASSES = ["Lead", "Position", "Claim", "Counterclaim", "Rebuttal", "Evidence", "Concluding Statement"]
_CLASS_SQL = "[" + ", ".join(f"'{c}'" for c in CLASSES) + "]"
DIMS = 64


def doc_words(t):
    return t.documents.filter(F.col("text").rlike(WORD)).select("doc_id", words(F.col("text")).alias("words"))


def text_parts(t):
    """Partitions for rows of single words, by the size of the texts."""
    return parts_for(t.documents, F.octet_length("text"))


def row_parts(t):
    """The same for texts with their words, pieces and spans as arrays of a row: a task holds a batch of them in the JVM and in Python."""
    return 2 * text_parts(t)


def class_name(code):
    return F.element_at(F.lit(CLASSES), (code + 1).cast("int"))


def _span_numbers(t):
    counted = doc_words(t).select("doc_id", F.size("words").alias("n"))
    steps = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 12))
    return counted.select("doc_id", "n", F.explode(steps).alias("k"))


def gold_spans(t):
    """Eight of every twelve words, classes in turn."""
    rows = _span_numbers(t)
    return rows.select(
        "doc_id",
        "k",
        (12 * F.col("k")).alias("start_word"),
        F.least(12 * F.col("k") + 7, F.col("n") - 1).alias("end_word"),
        class_name((F.col("doc_id") + F.col("k")) % 7).alias("class"),
    )


def predicted_spans(t):
    """Gold spans shifted by up to three words; every fifth has the wrong class."""
    rows = _span_numbers(t)
    wrong = F.when(F.col("k") % 5 == 0, 1).otherwise(0)
    spans = rows.select(
        "doc_id",
        "k",
        (12 * F.col("k") + F.col("k") % 4).alias("start_word"),
        F.least(12 * F.col("k") + 7 + F.col("k") % 3, F.col("n") - 1).alias("end_word"),
        class_name((F.col("doc_id") + F.col("k") + wrong) % 7).alias("class"),
    )
    return spans.filter("start_word <= end_word")


WORDS_SQL = f"""
dw AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {q.words('text')} AS w FROM documents) WHERE len(w) > 0)"""

SPANS_SQL = f"""{WORDS_SQL},
num AS (SELECT doc_id, n, unnest(generate_series(0, (n - 1) // 12)) AS k FROM dw),
gold AS (SELECT doc_id, k, 12 * k AS start_word, least(12 * k + 7, n - 1) AS end_word,
                ({_CLASS_SQL})[(doc_id + k) % 7 + 1] AS class FROM num),
pred AS (SELECT * FROM (
           SELECT doc_id, k, 12 * k + k % 4 AS start_word, least(12 * k + 7 + k % 3, n - 1) AS end_word,
                  ({_CLASS_SQL})[(doc_id + k + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) % 7 + 1] AS class FROM num)
         WHERE start_word <= end_word)"""

# Words with character offsets in the text whose words are joined by one blank.
OFFSETS_SQL = """
wo AS (SELECT doc_id, word_no, word, e - length(word) AS start_char, e AS end_char FROM (
         SELECT doc_id, i - 1 AS word_no, w[i] AS word,
                sum(length(w[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT - 1 AS e
         FROM (SELECT doc_id, w, unnest(generate_series(1, n)) AS i FROM dw)))"""


def offsets(t, parts=None, beside=None):
    """The words of each text with their character ranges, a row a text as of `word_offsets`."""
    texts = t.documents.filter(F.col("text").rlike(WORD)).select("doc_id", "text")
    return word_offsets(texts, "doc_id", words(F.col("text")), parts, beside)


_RANGES = ArrayType(StructType().add("at", IntegerType()).add("span_start", LongType()).add("span_end", LongType()))


def _span_ranges(start_word, end_word, word_no, start_char, end_char):
    """`(at, span_start, span_end)` for each span and each pair of words that have its first and its last number."""
    (first, begin, g_sizes, w_sizes), (last, finish, _, _) = (
        pairs_inside((no, no), (word_no, word_no), RANGE_BUCKET) for no in (start_word, end_word)
    )
    order = np.argsort(last, kind="stable")
    last, finish = last[order], finish[order]
    n = np.bincount(last, minlength=g_sizes.sum())
    before, many = np.cumsum(n) - n, n[first]
    span = np.repeat(first, many)
    until = finish[np.arange(len(span)) - np.repeat(np.cumsum(many) - many - before[first], many)]
    text = texts_of(g_sizes)
    at = span - (np.cumsum(g_sizes) - g_sizes)[text[span]]
    starts, ends = list_values(start_char)[1][np.repeat(begin, many)], list_values(end_char)[1][until]
    found = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(starts), pa.array(ends)], ["at", "span_start", "span_end"])
    order = pa.array(np.argsort(text[span], kind="stable"))
    return list_array(np.bincount(text[span], minlength=len(g_sizes)), found.take(order))


def char_spans(t, parts=None):
    """Gold spans as character ranges of the blank-joined text: `(doc_id, words, spans)`, `spans` a struct of arrays."""
    ranges = arrow_lists(_span_ranges, _RANGES)
    rows = offsets(t, parts, bundled(gold_spans(t), "doc_id", "gold", parts))
    longs = [F.col(f"gold.{c}").cast("array<bigint>") for c in ("start_word", "end_word")]
    found = rows.withColumn("at", ranges(*longs, F.col("words.word_no").cast("array<bigint>"), F.col("words.start_char"), F.col("words.end_char")))
    picked = lambda c: F.transform("at.at", lambda i: F.get(F.col(f"gold.{c}"), i)).alias(c)
    return found.select("doc_id", "words", F.struct(picked("k"), picked("class"), F.col("at.span_start").alias("span_start"), F.col("at.span_end").alias("span_end")).alias("spans"))


CHAR_SPANS_SQL = """
cs AS (SELECT g.*, a.start_char AS span_start, b.end_char AS span_end FROM gold g
       JOIN wo a ON a.doc_id = g.doc_id AND a.word_no = g.start_word
       JOIN wo b ON b.doc_id = g.doc_id AND b.word_no = g.end_word)"""


def vocabulary(t):
    """Distinct lower-case words with their document counts."""
    tokens = t.documents.select("doc_id", F.explode(F.array_distinct(words(F.lower("text")))).alias("word"))
    return tokens.groupBy("word").agg(F.count("*").alias("df"))


VOCABULARY_SQL = f"""
vocab AS (SELECT word, count(*) AS df FROM (
            SELECT doc_id, unnest(list_distinct({q.words('lower(text)')})) AS word FROM documents) GROUP BY word)"""


def stop_words(t):
    """The fifty most widespread words stand in for a stop-word corpus."""
    return vocabulary(t).orderBy(F.desc("df"), "word").limit(50)


STOP_SQL = f"""{VOCABULARY_SQL},
stop AS (SELECT word FROM vocab ORDER BY df DESC, word LIMIT 50)"""


def word_vectors(t):
    """Word -> vector: the word's hash picks a row of `embeddings`; a tenth of the words have none."""
    n = t.embeddings.count()
    place = hash_key(F.col("word"), 7)
    picked = vocabulary(t).withColumn("vec_id", place % n).filter(place % 10 != 0)
    return picked.join(t.embeddings.select("vec_id", F.col("embedding").alias("vec")), "vec_id").select("word", "vec")


WORD_VECTORS_SQL = f"""{VOCABULARY_SQL},
wv AS (SELECT word, embedding AS vec FROM (
         SELECT word, {q.hash_key('word', 7)} AS h FROM vocab) v
       JOIN embeddings e ON e.vec_id = v.h % (SELECT count(*) FROM embeddings) WHERE v.h % 10 <> 0)"""


def lexicon(t):
    """Word scores -4..4 from the word's hash; zero scores are left out."""
    scored = vocabulary(t).select("word", (hash_key(F.col("word"), 3) % 9 - 4).alias("score"))
    return scored.filter("score <> 0")


LEXICON_SQL = f"""{VOCABULARY_SQL},
lex AS (SELECT * FROM (SELECT word, {q.hash_key('word', 3)} % 9 - 4 AS score FROM vocab) WHERE score <> 0)"""


def gazetteer(t):
    """A third of the longer words name an entity of one of three types."""
    place = hash_key(F.col("word"), 11)
    listed = vocabulary(t).filter((F.length("word") >= 6) & (place % 3 == 0))
    return listed.select("word", F.element_at(F.lit(["ORG", "GPE", "PERSON"]), (place % 9 / 3 + 1).cast("int")).alias("type"))


GAZETTEER_SQL = f"""{VOCABULARY_SQL},
gaz AS (SELECT word, (['ORG', 'GPE', 'PERSON'])[(h % 9) // 3 + 1] AS type FROM (
          SELECT word, {q.hash_key('word', 11)} AS h FROM vocab WHERE length(word) >= 6) WHERE h % 3 = 0)"""
