"""Order-dependent operators: ranks, runs, running sums, softmax families."""

from pyspark.sql import functions as F

from textloom.functions import decoding, vectors
from textloom.functions.text import word_count
from textloom.operators import labels as lb
from textloom.operators import ordering, prompts, splits
from textloom.operators import statistics as st
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query, r

# Softmax of every vector, long form: (vec_id, idx, p).
SOFTMAX_SQL = """
lg AS (SELECT vec_id, unnest(generate_series(0, 63)) AS idx, unnest(embedding)::DOUBLE * 10 AS x FROM embeddings),
sm AS (SELECT vec_id, idx, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM (
         SELECT vec_id, idx, exp((x - max(x) OVER (PARTITION BY vec_id)) / 2.0::DOUBLE) AS e FROM lg))"""


def _logits():
    return F.transform("embedding", lambda x: x.cast("double") * 10)


@query(
    "w1_top_per_group",
    """
    SELECT o_custkey, o_orderkey, rank FROM (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders)
    WHERE rank <= 3
    """,
)
def top_per_group(t):
    ranked = st.top_per_group(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return ranked.select("o_custkey", "o_orderkey", "rank")


@query(
    "w2_span_order_check",
    f"""
    WITH {fx.SPANS_SQL}
    SELECT * FROM (SELECT doc_id, k, start_word, lag(start_word) OVER (PARTITION BY doc_id ORDER BY class, k) AS previous FROM pred)
    WHERE start_word <= previous
    """,
)
def span_order_check(t):
    """Ordered by class instead of position, so the check has something to report."""
    spans = fx.predicted_spans(t).withColumn("spot", F.struct("class", "k"))
    bad = splits.violations_in_order(spans, "doc_id", "spot", "start_word", F.struct("class", ordering.place_block("k")))
    return bad.select("doc_id", "k", "start_word", "previous")


@query(
    "w3_history_budget",
    f"""
    WITH {q.PAIRS}
    SELECT conv_id, pair_turn, tokens, used_tokens FROM (
      SELECT conv_id, pair_turn, tokens, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pair_turn DESC)::BIGINT AS used_tokens
      FROM (SELECT conv_id, pair_turn, ({q.word_count('question')} + {q.word_count('answer')})::BIGINT AS tokens FROM pairs))
    WHERE used_tokens <= 120
    """,
)
def history_budget(t):
    kept = prompts.within_budget(prompts.turn_pairs(t.conversations, word_count(F.col("text"))), 120)
    return kept.select("conv_id", "pair_turn", "tokens", "used_tokens")


@query("w4_turn_pairs", f"WITH {q.PAIRS} SELECT conv_id, pair_turn, question, answer FROM pairs")
def turn_pairs(t):
    return prompts.turn_pairs(t.conversations)


@query("w5_softmax", f"WITH {SOFTMAX_SQL} SELECT vec_id, idx::INTEGER AS idx, {q.r('p')} AS p FROM sm")
def softmax(t):
    """Temperature 2 over 64 logits per row; nothing is shuffled."""
    probs = t.embeddings.select("vec_id", vectors.softmax(_logits(), 2.0).alias("p"))
    return probs.select("vec_id", F.posexplode("p").alias("idx", "p")).select("vec_id", "idx", r("p").alias("p"))


@query(
    "w6_top_choices",
    f"""
    WITH {SOFTMAX_SQL}
    SELECT vec_id, rank, ' token' || idx || printf(' (%.2f%%)', 100 * p) AS choice FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx)::INTEGER AS rank FROM sm) WHERE rank <= 5
    """,
)
def top_choices(t):
    choices = decoding.top_choices(vectors.softmax(_logits(), 2.0), 5, "token")
    return t.embeddings.select("vec_id", F.posexplode(choices).alias("at", "choice")).select(
        "vec_id", (F.col("at") + 1).alias("rank"), "choice"
    )


@query(
    "w7_nucleus",
    f"""
    WITH {SOFTMAX_SQL},
    c AS (SELECT vec_id, idx, p, coalesce(sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm)
    SELECT vec_id, idx::INTEGER AS idx, {q.r('p / sum(p) OVER (PARTITION BY vec_id)')} AS p FROM c WHERE before <= 0.9
    """,
)
def nucleus(t):
    kept = decoding.nucleus(vectors.softmax(_logits(), 2.0), 0.9)
    rows = t.embeddings.select("vec_id", F.explode(kept).alias("s"))
    return rows.select("vec_id", F.col("s.idx").alias("idx"), r("s.p").alias("p"))


@query(
    "w8_gate_routing",
    f"""
    WITH {SOFTMAX_SQL},
    k AS (SELECT vec_id, idx, x FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, idx) AS rank FROM lg) WHERE rank <= 2),
    w AS (SELECT vec_id, idx, exp(x - max(x) OVER p) / sum(exp(x)) OVER p * exp(max(x) OVER p) AS weight FROM k WINDOW p AS (PARTITION BY vec_id))
    SELECT idx::INTEGER AS expert, count(*) AS load, {q.r('sum(weight)', 4)} AS weight FROM w GROUP BY idx
    """,
)
def gate_routing(t):
    routed = t.embeddings.select("vec_id", F.explode(decoding.route(_logits(), 2)).alias("g"))
    load = routed.groupBy(F.col("g.expert").alias("expert")).agg(F.count("*").alias("load"), F.sum("g.weight").alias("weight"))
    return load.select("expert", "load", r("weight", 4).alias("weight"))


@query(
    "w9_argmax",
    "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS best FROM embeddings",
)
def argmax(t):
    return t.embeddings.select("vec_id", vectors.argmax(F.col("embedding")).alias("best"))


@query(
    "w10_equal_runs",
    """
    WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)
                 - row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) AS g FROM
                 (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL))
    SELECT l_orderkey, l_returnflag, min(l_linenumber)::INTEGER AS start_pos, max(l_linenumber)::INTEGER AS end_pos, count(*) AS run_length
    FROM s GROUP BY l_orderkey, l_returnflag, g
    """,
)
def equal_runs(t):
    unique = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))
    return lb.equal_runs(unique, "l_orderkey", "l_linenumber", "l_returnflag")


@query(
    "w11_metric_fill",
    """
    WITH l AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN value END AS metric FROM events)
    SELECT event_id, coalesce(last_value(metric IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id),
                              first_value(metric IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS metric
    FROM l
    """,
)
def metric_fill(t):
    log = t.events.withColumn("metric", F.when(F.col("event_type") == "click", F.col("value")))
    return ordering.fill_gaps(log, ["user_id"], "event_id", "metric").select("event_id", "metric")


@query(
    "w12_dense_index",
    f"""SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents
        WHERE {q.word_count('text')} >= 20""",
)
def dense_index(t):
    long_enough = t.documents.filter(word_count(F.col("text")) >= 20).select("doc_id")
    return ordering.dense_index(long_enough, "doc_id", "row_idx")


@query(
    "w13_first_prediction",
    f"""
    WITH {fx.WORDS_SQL},
    ch AS (SELECT doc_id, n, c, unnest(generate_series(c * 40, least(c * 40 + 63, n - 1))) AS word_no
           FROM (SELECT doc_id, n, unnest(generate_series(0, greatest(0, (n - 64 + 39) // 40))) AS c FROM dw)),
    lab AS (SELECT doc_id, word_no, 'L' || (word_no + c) % 5 AS label, row_number() OVER (PARTITION BY doc_id, word_no ORDER BY c) AS i FROM ch)
    SELECT doc_id, word_no, label FROM lab WHERE i = 1
    """,
)
def first_prediction(t):
    """Windows of 64 words that overlap by 24; each window labels its words."""
    counted = fx.doc_words(t).select("doc_id", F.size("words").cast("bigint").alias("n"))
    counted = ordering.by_key(counted, ["doc_id"], fx.text_parts(t))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.floor((F.col("n") - 25) / 40)))
    windows = counted.select("doc_id", "n", F.explode(chunks).alias("chunk_no"))
    first = F.col("chunk_no") * 40
    rows = windows.select("doc_id", "chunk_no", F.posexplode(F.sequence(first, F.least(first + 63, F.col("n") - 1))).alias("pos", "word_no"))
    labelled = rows.withColumn("label", F.concat(F.lit("L"), (F.col("word_no") + F.col("chunk_no")) % 5))
    return lb.first_prediction(labelled, "doc_id")
