"""Splits, folds, samples and label codes."""

from pyspark.sql import functions as F

from textloom.functions.hashing import HASH_SPACE, hash_key
from textloom.operators import splits
from textloom.plans import sqltext as q
from textloom.plans.registry import query

SEED = 42


@query(
    "x1_ratio_split",
    f"""SELECT doc_id, CASE WHEN {q.hash_key('doc_id', SEED)} < {int(0.7 * HASH_SPACE)} THEN 'train'
               WHEN {q.hash_key('doc_id', SEED)} < {int(0.85 * HASH_SPACE)} THEN 'validation' ELSE 'test' END AS split,
               CASE WHEN {q.hash_key('doc_id', SEED)} >= {int(0.9 * HASH_SPACE)} THEN 'test'
               WHEN {q.hash_key('doc_id', SEED + 1)} >= {int(0.9 * HASH_SPACE)} THEN 'validation' ELSE 'train' END AS nested FROM documents""",
)
def ratio_split(t):
    ids = t.documents.select("doc_id")
    flat = splits.ratio_split(ids, "doc_id", {"train": 0.7, "validation": 0.15, "test": 0.15}, SEED)
    nested = splits.nested_split(flat.withColumnRenamed("split", "flat"), "doc_id", 0.9, 0.9, SEED)
    return nested.select("doc_id", F.col("flat").alias("split"), F.col("split").alias("nested"))


@query(
    "x2_positional_split",
    """SELECT doc_id, CASE WHEN i < n * 0.5 // 1 THEN 'train' WHEN i < n * 0.75 // 1 THEN 'test' ELSE 'validation' END AS split
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)""",
)
def positional_split(t):
    shares = {"train": 0.5, "test": 0.25, "validation": 0.25}
    return splits.positional_split(t.documents.select("doc_id"), "doc_id", shares).select("doc_id", "split")


@query(
    "x2_offset_split",
    """WITH o AS (SELECT doc_id, text, coalesce(sum(length(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM documents),
    c AS (SELECT floor((sum(length(text) + 1) - 1) * 0.95::DOUBLE)::BIGINT AS c FROM documents),
    p AS (SELECT doc_id, text, greatest(0, least(length(text), c - s)) AS k FROM o, c)
    SELECT doc_id, 'train' AS split, substr(text, 1, k) AS piece FROM p WHERE k > 0
    UNION ALL SELECT doc_id, 'test', substr(text, k + 1) FROM p WHERE k < length(text)""",
)
def offset_split(t):
    """95 percent of the characters of the joined corpus, cut inside a text if need be."""
    return splits.offset_split(t.documents.select("doc_id", "text"), "doc_id", F.col("text"), 0.95)


@query(
    "x3_id_split",
    f"""SELECT conv_id, turn, CASE WHEN {q.hash_key('conv_id', SEED)} < {int(0.9 * HASH_SPACE)} THEN 'train' ELSE 'validation' END AS split FROM conversations""",
)
def id_split(t):
    return splits.ratio_split(t.conversations, "conv_id", {"train": 0.9, "validation": 0.1}, SEED).select("conv_id", "turn", "split")


@query("x4_group_folds", f"SELECT doc_id, ({q.hash_key('text', SEED)} % 5)::INTEGER AS fold FROM documents")
def group_folds(t):
    return splits.group_folds(t.documents, "text", 5, SEED).select("doc_id", "fold")


@query(
    "x4_balanced_folds",
    """WITH s AS (SELECT text, row_number() OVER (ORDER BY count(*) DESC, text COLLATE C) - 1 AS r FROM documents GROUP BY text)
    SELECT doc_id, (CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END)::INTEGER AS fold FROM documents JOIN s USING (text)""".replace(
        " COLLATE C", ""
    ),
)
def balanced_folds(t):
    return splits.balanced_group_folds(t.documents, "text", 5).select("doc_id", "fold")


@query("x5_hash_key", f"SELECT event_id, {q.hash_key('event_id', SEED)} AS place FROM events")
def hash_places(t):
    return t.events.select("event_id", hash_key(F.col("event_id"), SEED).alias("place"))


# Shares of the four languages.
SHARES = {"de": 0.629, "fr": 0.229, "es": 0.084, "en": 0.059}


@query(
    "x6_proportional_sample",
    f"""WITH s(lang, share) AS (VALUES ('de', 0.629::DOUBLE), ('fr', 0.229::DOUBLE), ('es', 0.084::DOUBLE), ('en', 0.059::DOUBLE)),
    r AS (SELECT doc_id, lang, share, count(*) OVER (PARTITION BY lang) AS n,
                 row_number() OVER (PARTITION BY lang ORDER BY {q.hash_key('doc_id', 0)}, doc_id) - 1 AS rank FROM documents JOIN s USING (lang))
    SELECT doc_id, lang, rank FROM r WHERE rank < floor(n * share)""",
)
def proportional_sample(t):
    return splits.proportional_sample(t.documents.select("doc_id", "lang"), "lang", "doc_id", SHARES, 0)


@query(
    "x7_learning_subsets",
    f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {q.hash_key('doc_id', 3)}, doc_id) - 1 AS rank FROM documents)
    SELECT subset, doc_id FROM r, (SELECT unnest([250, 500, 1000, 2000, 4000]) AS subset) WHERE rank < subset""",
)
def learning_subsets(t):
    drawn = splits.learning_subsets(t.documents.select("doc_id"), "doc_id", [250, 500, 1000, 2000, 4000], 3)
    return drawn.select("subset", "doc_id")


@query(
    "x8_label_codes",
    """WITH s AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS sorted_code, row_number() OVER (ORDER BY f) - 1 AS seen_code
                 FROM (SELECT lang, min(doc_id) AS f FROM documents GROUP BY lang))
    SELECT doc_id, lang, sorted_code, seen_code FROM documents JOIN s USING (lang)""",
)
def label_codes(t):
    coded = splits.encode_sorted(t.documents.select("doc_id", "lang"), "lang", "sorted_code")
    return splits.encode_first_seen(coded, "lang", "doc_id", "seen_code").select("doc_id", "lang", "sorted_code", "seen_code")
