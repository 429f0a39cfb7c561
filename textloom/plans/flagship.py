"""End-to-end jobs built from the operators."""

from pyspark.sql import functions as F

from textloom.functions import templates as tp
from textloom.functions.hashing import HASH_SPACE
from textloom.functions.text import words
from textloom.operators import prompts, splits
from textloom.operators import statistics as st
from textloom.operators import tokens as tk
from textloom.plans import sqltext as q
from textloom.plans.registry import query, r

SEED, CAP = 42, 10_000
_RENDERED = "'<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10)"


@query(
    "e1_instruction_preparation",
    f"""WITH {q.PAIRS},
    x AS (SELECT pair_turn, conv_id, {_RENDERED} AS text FROM pairs),
    tok AS (SELECT pair_turn, conv_id, unnest({q.words('text')}) AS word FROM x),
    voc AS (SELECT word FROM tok GROUP BY word ORDER BY count(*) DESC, word LIMIT {CAP}),
    n AS (SELECT conv_id, pair_turn, count(*)::INTEGER AS n FROM tok JOIN voc USING (word) GROUP BY ALL),
    s AS (SELECT *, CASE WHEN {q.hash_key('conv_id', SEED)} < {int(0.9 * HASH_SPACE)} THEN 'train' ELSE 'validation' END AS split FROM n)
    SELECT split, count(*) AS examples, sum(n)::BIGINT AS tokens, {q.r('avg(n)')} AS mean_tokens, min(n) AS low, quantile_cont(n, 0.5) AS median, max(n) AS high FROM s GROUP BY split""",
)
def instruction_preparation(t):
    """Turns -> pairs -> ChatML -> vocabulary and token ids -> conversation split -> length summary."""
    pairs = prompts.turn_pairs(t.conversations)
    text = F.concat(tp.chatml_turn(F.lit("user"), F.col("question")), tp.chatml_turn(F.lit("assistant"), F.col("answer")))
    rows = pairs.select("conv_id", "pair_turn", text.alias("text"))
    w = words(F.col("text"))
    encoded = tk.encode(rows, ["conv_id", "pair_turn"], w, tk.fit_vocabulary(rows, w, CAP), CAP)
    sized = encoded.select("conv_id", F.size("ids").alias("n_tokens"))
    split = splits.ratio_split(sized, "conv_id", {"train": 0.9, "validation": 0.1}, SEED)
    counted = split.groupBy("split", "n_tokens").agg(F.count("*").alias("k"))
    median = F.percentile("n_tokens", 0.5, F.col("k"))
    total = F.sum(F.col("n_tokens") * F.col("k"))
    return counted.groupBy("split").agg(
        F.sum("k").alias("examples"),
        total.alias("tokens"),
        r(total / F.sum("k")).alias("mean_tokens"),
        F.min("n_tokens").alias("low"),
        median.alias("median"),
        F.max("n_tokens").alias("high"),
    )
