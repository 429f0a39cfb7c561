"""Vocabulary, encoding, windows and packing."""

from pyspark.sql import functions as F

from textloom.functions import arrays as ar
from textloom.functions.text import words
from textloom.operators import tokens as tk
from textloom.operators.prompts import turn_pairs
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query
from textloom.sources.scratch import durable

CAP = 10_000
LOW = F.lower
_W = q.words("lower(text)")

VOCAB_SQL = f"""
voc AS (SELECT word, row_number() OVER (ORDER BY n DESC, word)::INTEGER AS id, n FROM (
          SELECT word, count(*) AS n FROM (SELECT unnest({_W}) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT {CAP})),
tok AS (SELECT doc_id, i - 1 AS pos, w[i] AS word FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM (SELECT doc_id, {_W} AS w FROM documents))),
enc AS (SELECT d.doc_id, coalesce(ids, []::INTEGER[]) AS ids, coalesce(word_ids, []::INTEGER[]) AS word_ids FROM documents d LEFT JOIN (
          SELECT doc_id, list(id ORDER BY pos) AS ids, list(pos::INTEGER ORDER BY pos) AS word_ids FROM tok JOIN voc USING (word) GROUP BY doc_id) e USING (doc_id))"""


def _vocabulary(t):
    return tk.fit_vocabulary(t.documents, words(LOW("text")), CAP)


def encoded(t, parts=None):
    return tk.encode(t.documents, "doc_id", words(LOW("text")), _vocabulary(t), CAP, parts)


@query("k1_vocabulary", f"WITH {VOCAB_SQL} SELECT word, id, n FROM voc")
def vocabulary(t):
    return _vocabulary(t)


@query("k2_encode", f"WITH {VOCAB_SQL} SELECT doc_id, {q.csv('ids')} AS ids, len(ids)::INTEGER AS n_tokens FROM enc")
def encode(t):
    return encoded(t).select("doc_id", csv("ids").alias("ids"), F.size("ids").alias("n_tokens"))


@query(
    "k2_round_trip",
    f"WITH {VOCAB_SQL} SELECT d.doc_id, coalesce(text, '') AS text FROM (SELECT doc_id FROM documents) d LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM tok JOIN voc USING (word) GROUP BY doc_id) USING (doc_id)",
)
def round_trip(t):
    parts = fx.text_parts(t)
    return tk.decode(encoded(t, parts), "doc_id", F.col("ids"), F.broadcast(_vocabulary(t)), parts)


_FRAMED = "list_concat(list_concat([101], ids[1:126]), [102])"


@query(
    "k3_pad_and_mask",
    f"""WITH {VOCAB_SQL}, f AS (SELECT doc_id, {_FRAMED} AS f FROM enc)
    SELECT doc_id, {q.csv('list_resize(f, 128, 0)')} AS ids,
           {q.csv('list_resize(list_transform(f, lambda x: 1), 128, 0)')} AS attention,
           ((len(f) + 15) // 16 * 16)::INTEGER AS width_16,
           {q.csv('list_concat(list_resize([]::INTEGER[], 128 - len(f), 0), f)')} AS left_ids FROM f""",
)
def pad_and_mask(t):
    rows = encoded(t).select("doc_id", ar.framed(F.col("ids"), 128).alias("f"))
    f = F.col("f")
    return rows.select(
        "doc_id",
        csv(ar.padded(f, 128)).alias("ids"),
        csv(ar.mask(f, 128)).alias("attention"),
        ar.rounded_width(F.size(f), 16).alias("width_16"),
        csv(ar.padded(f, 128, left=True)).alias("left_ids"),
    )


@query(
    "k4_causal_labels",
    f"""WITH {VOCAB_SQL}, f AS (SELECT doc_id, {_FRAMED} AS f FROM enc)
    SELECT doc_id, {q.csv('list_resize(f, 128, -100)')} AS labels FROM f""",
)
def causal_labels(t):
    rows = encoded(t).select("doc_id", ar.framed(F.col("ids"), 128).alias("f"))
    labels = ar.causal_labels(ar.padded(F.col("f"), 128), ar.mask(F.col("f"), 128))
    return rows.select("doc_id", csv(labels).alias("labels"))


@query(
    "k5_pair_encoding",
    f"""WITH {q.PAIRS},
    e AS (SELECT conv_id, pair_turn, list_transform({q.words('question')}, lambda x: length(x)::INTEGER) AS a,
                 list_transform({q.words('answer')}, lambda x: length(x)::INTEGER) AS b FROM pairs)
    SELECT conv_id, pair_turn, {q.csv('list_concat(list_concat(list_concat([101], a), [102]), list_concat(b, [102]))')} AS ids,
           {q.csv('list_concat(list_resize([]::INTEGER[], len(a) + 2, 0), list_resize([]::INTEGER[], len(b) + 1, 1))')} AS segments FROM e""",
)
def pair_encoding(t):
    """Word lengths stand for ids: only the framing matters here."""
    code = lambda c: F.transform(words(F.col(c)), lambda w: F.length(w))
    pairs = turn_pairs(t.conversations).select("conv_id", "pair_turn", code("question").alias("a"), code("answer").alias("b"))
    a, b = F.col("a"), F.col("b")
    return pairs.select(
        "conv_id", "pair_turn", csv(ar.pair_ids(a, b)).alias("ids"), csv(ar.pair_segments(a, b)).alias("segments")
    )


@query(
    "k6_fixed_windows",
    f"""WITH {VOCAB_SQL}, c AS (SELECT doc_id, ids, unnest(generate_series(0, greatest(0, (len(ids) - 1) // 510))) AS c FROM enc)
    SELECT doc_id, c::INTEGER AS chunk_no, {q.csv('list_resize(list_concat(list_concat([101], ids[c * 510 + 1 : c * 510 + 510]), [102]), 512, 0)')} AS ids FROM c""",
)
def fixed_windows(t):
    chunks = encoded(t).select("doc_id", F.posexplode(ar.windows(F.col("ids"), 510)).alias("chunk_no", "w"))
    return chunks.select("doc_id", "chunk_no", csv(ar.padded(ar.framed(F.col("w"), 512), 512)).alias("ids"))


@query(
    "k7_overlapping_windows",
    f"""WITH {VOCAB_SQL}, c AS (SELECT *, unnest(generate_series(0, greatest(0, (len(ids) - 510 + 381) // 382))) AS c FROM enc)
    SELECT doc_id, c::INTEGER AS chunk_no, {q.csv('ids[c * 382 + 1 : c * 382 + 510]')} AS ids, {q.csv('word_ids[c * 382 + 1 : c * 382 + 510]')} AS word_ids FROM c""",
)
def overlapping_windows(t):
    both = F.arrays_zip("ids", "word_ids")
    chunks = encoded(t).select("doc_id", F.posexplode(ar.windows(both, 510, 128)).alias("chunk_no", "w"))
    return chunks.select(
        "doc_id",
        "chunk_no",
        csv(F.transform("w", lambda x: x["ids"])).alias("ids"),
        csv(F.transform("w", lambda x: x["word_ids"])).alias("word_ids"),
    )


_STREAM_SQL = """
st AS (SELECT doc_id, unnest(list_append(ids, 0)) AS id, unnest(generate_series(1, len(ids) + 1)) AS i FROM enc),
nu AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS spot FROM st)"""


@query(
    "k15_packed_blocks",
    f"WITH {VOCAB_SQL}, {_STREAM_SQL} SELECT spot // 2048 AS block, count(*)::INTEGER AS n, string_agg(id::VARCHAR, ',' ORDER BY spot) AS ids FROM nu GROUP BY 1",
)
def packed_blocks(t):
    blocks = tk.pack(encoded(t), "doc_id", "ids", 2048)
    return blocks.select("block", F.size("ids").alias("n"), csv("ids").alias("ids"))


@query(
    "k16_calibration_windows",
    f"""WITH {VOCAB_SQL}, {_STREAM_SQL},
    n AS (SELECT count(*) AS n FROM nu),
    w AS (SELECT i AS "window", (h % greatest(1, n - 256 + 1))::BIGINT AS start FROM (SELECT i, {q.hash_key('i', 9, 60)} AS h FROM range(32) r(i)), n)
    SELECT "window", start, string_agg(id::VARCHAR, ',' ORDER BY spot) AS ids FROM w JOIN nu ON spot >= start AND spot < start + 256 GROUP BY ALL""",
)
def calibration_windows(t):
    drawn = tk.calibration_windows(encoded(t), "doc_id", "ids", count=32, length=256, seed=9)
    return drawn.select("window", "start", csv("ids").alias("ids"))


@query("k17_batches", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 64 AS batch FROM orders")
def batches(t):
    return tk.batch_ids(t.orders.select("o_orderkey"), "o_orderkey", 64).select("o_orderkey", "batch")


@query(
    "k18_length_budgets",
    f"""WITH {q.PAIRS}, e AS (SELECT conv_id, pair_turn, {q.words('question')} AS a, {q.words('answer')} AS b FROM pairs),
    p AS (SELECT conv_id, pair_turn, CASE WHEN len(a) > 20 THEN a[-20:] ELSE a END AS p, b FROM e)
    SELECT conv_id, pair_turn, array_to_string(p, ' ') AS prompt, array_to_string(b[1:least(30, 40 - len(p))], ' ') AS answer FROM p""",
)
def length_budgets(t):
    """Prompt keeps its last 20 words, the answer its first 30, the pair at most 40."""
    pairs = turn_pairs(t.conversations)
    cut = pairs.select("conv_id", "pair_turn", ar.keep_tail(words(F.col("question")), 20).alias("p"), words(F.col("answer")).alias("b"))
    answer = ar.keep_head(F.col("b"), F.least(F.lit(30), 40 - F.size("p")))
    return cut.select("conv_id", "pair_turn", F.array_join("p", " ").alias("prompt"), F.array_join(answer, " ").alias("answer"))
