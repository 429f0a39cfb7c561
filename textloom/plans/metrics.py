"""Scores of predictions, spans, summaries and generated text."""

from pyspark.sql import functions as F

from textloom.functions import fuzzy
from textloom.functions import vectors as vc
from textloom.functions.text import words
from textloom.operators import labels as lb
from textloom.operators import metrics as mt
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.labels import runs_sql, tags_sql, text_sizes
from textloom.plans.registry import csv, query, r
from textloom.sources.scratch import durable

PREDICTED_SQL = "pr AS (SELECT vec_id, label, (list_position(embedding[1:10], list_max(embedding[1:10])) - 1)::INTEGER AS prediction FROM embeddings)"


def predictions(t):
    """The largest of the first ten components is the predicted class."""
    return t.embeddings.select("vec_id", "label", vc.argmax(F.slice("embedding", 1, 10)).alias("prediction"))


@query(
    "q1_class_report",
    f"""WITH {PREDICTED_SQL},
    k AS (SELECT class, sum(tp) AS tp, sum(s) AS support, sum(p) AS predicted FROM (
            SELECT label AS class, (label = prediction)::INTEGER AS tp, 1 AS s, 0 AS p FROM pr UNION ALL SELECT prediction, 0, 0, 1 FROM pr) GROUP BY class),
    m AS (SELECT class, support, tp, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall,
                 coalesce(2.0::DOUBLE * tp / nullif(support + predicted, 0), 0) AS f1 FROM k)
    SELECT class::VARCHAR AS class, {q.r('precision')} AS precision, {q.r('recall')} AS recall, {q.r('f1')} AS f1, support::BIGINT AS support FROM m
    UNION ALL SELECT 'accuracy', {q.r('sum(tp)::DOUBLE / sum(support)')}, {q.r('sum(tp)::DOUBLE / sum(support)')}, {q.r('sum(tp)::DOUBLE / sum(support)')}, sum(support)::BIGINT FROM m
    UNION ALL SELECT 'macro avg', {q.r('avg(precision)')}, {q.r('avg(recall)')}, {q.r('avg(f1)')}, sum(support)::BIGINT FROM m
    UNION ALL SELECT 'weighted avg', {q.r('sum(precision * support) / sum(support)')}, {q.r('sum(recall * support) / sum(support)')}, {q.r('sum(f1 * support) / sum(support)')}, sum(support)::BIGINT FROM m""",
)
def class_report(t):
    report = mt.class_report(predictions(t), "label", "prediction")
    return report.select("class", *[r(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "q2_confusion_matrix",
    f"WITH {PREDICTED_SQL} SELECT label, "
    + ", ".join(f'count(*) FILTER (prediction = {i}) AS "{i}"' for i in range(10))
    + " FROM pr GROUP BY label",
)
def confusion_matrix(t):
    return mt.confusion(predictions(t), "label", "prediction", range(10))


def _with_ids(spans):
    return spans.select("doc_id", "class", F.col("k").alias("span_id"), "start_word", "end_word")


_OVERLAP_SQL = f"""{fx.SPANS_SQL},
ov AS (SELECT g.doc_id, g.class, g.k AS gt_id, p.k AS pred_id, g.end_word - g.start_word + 1 AS gl, p.end_word - p.start_word + 1 AS pl,
              least(g.end_word, p.end_word) - greatest(g.start_word, p.start_word) + 1 AS shared
       FROM gold g JOIN pred p ON g.doc_id = p.doc_id AND g.class = p.class AND g.start_word <= p.end_word AND p.start_word <= g.end_word),
hit AS (SELECT *, greatest(shared::DOUBLE / gl, shared::DOUBLE / pl) AS best FROM ov WHERE 2 * shared >= gl AND 2 * shared >= pl),
ch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, class, gt_id ORDER BY best DESC, pred_id) AS i FROM hit) WHERE i = 1),
cn AS (SELECT class, (SELECT count(*) FROM ch WHERE ch.class = c.class) AS tp,
              (SELECT count(*) FROM pred WHERE pred.class = c.class) - (SELECT count(DISTINCT (doc_id, pred_id)) FROM ch WHERE ch.class = c.class) AS fp,
              (SELECT count(*) FROM gold WHERE gold.class = c.class) - (SELECT count(*) FROM ch WHERE ch.class = c.class) AS fn
       FROM (SELECT DISTINCT class FROM gold) c)"""


@query(
    "q3_span_f1",
    f"WITH {_OVERLAP_SQL} SELECT class, tp, fp, fn, {q.r('tp / (tp + 0.5::DOUBLE * (fp + fn))')} AS f1 FROM cn",
)
def span_f1(t):
    scored = mt.span_f1(_with_ids(fx.gold_spans(t)), _with_ids(fx.predicted_spans(t)), "doc_id")
    return scored.select("class", "tp", "fp", "fn", r("f1").alias("f1"))


@query(
    "q3_mean_f1",
    f"WITH {_OVERLAP_SQL} SELECT count(*) AS classes, {q.r('avg(tp / (tp + 0.5::DOUBLE * (fp + fn)))')} AS mean_f1 FROM cn",
)
def mean_span_f1(t):
    scored = mt.span_f1(_with_ids(fx.gold_spans(t)), _with_ids(fx.predicted_spans(t)), "doc_id")
    return scored.agg(F.count("*").alias("classes"), r(F.avg("f1")).alias("mean_f1"))


@query(
    "q3_span_f1_compat",
    f"""WITH {_OVERLAP_SQL},
    g AS (SELECT DISTINCT doc_id, class FROM gold), p AS (SELECT DISTINCT doc_id, class FROM pred),
    x AS (SELECT class, tp, fp + (EXISTS (SELECT 1 FROM g WHERE g.class = cn.class AND NOT EXISTS (SELECT 1 FROM p WHERE p.doc_id = g.doc_id AND p.class = g.class)))::INTEGER AS fp,
                 fn + (EXISTS (SELECT 1 FROM p WHERE p.class = cn.class AND NOT EXISTS (SELECT 1 FROM g WHERE p.doc_id = g.doc_id AND p.class = g.class)))::INTEGER AS fn FROM cn)
    SELECT class, tp, fp, fn, {q.r('tp / (tp + 0.5::DOUBLE * (fp + fn))')} AS f1 FROM x""",
)
def span_f1_compat(t):
    scored = mt.span_f1(_with_ids(fx.gold_spans(t)), _with_ids(fx.predicted_spans(t)), "doc_id", reference_compat=True)
    return scored.select("class", "tp", "fp", "fn", r("f1").alias("f1"))


@query(
    "q4_entity_scores",
    f"""WITH {fx.SPANS_SQL}, {tags_sql('gold', 'tg')}, {tags_sql('pred', 'tp')}, {runs_sql('tg', 'sg')}, {runs_sql('tp', 'sp')},
    n AS (SELECT (SELECT count(*) FROM sg JOIN sp USING (doc_id, class, start_word, end_word)) AS tp, (SELECT count(*) FROM sg) AS n_true, (SELECT count(*) FROM sp) AS n_predicted)
    SELECT tp, n_true, n_predicted, {q.r('tp::DOUBLE / n_predicted')} AS precision, {q.r('tp::DOUBLE / n_true')} AS recall, {q.r('2.0::DOUBLE * tp / (n_true + n_predicted)')} AS f1 FROM n""",
)
def entity_scores(t):
    parts = fx.text_parts(t)
    found = [
        lb.tag_spans(lb.bio_tags(text_sizes(t), spans, "doc_id", parts), "doc_id")
        for spans in (fx.gold_spans(t), fx.predicted_spans(t))
    ]
    scores = mt.entity_scores(*found, ["doc_id", "class", "start_word", "end_word"])
    return scores.select("tp", "n_true", "n_predicted", *[r(c).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "q5_masked_accuracy",
    f"""WITH {fx.WORDS_SQL}, x AS (SELECT doc_id, i, length(w[i]) % 7 AS label, (length(w[i]) + (i % 5 = 0)::INTEGER) % 7 AS prediction
                                  FROM (SELECT doc_id, w, unnest(generate_series(1, n)) AS i FROM dw))
    SELECT count(*) FILTER (label = prediction) AS hits, count(*) AS counted, {q.r('avg((label = prediction)::INTEGER)')} AS accuracy FROM x WHERE i % 4 <> 0""",
)
def masked_accuracy(t):
    """Every fourth word is a masked place; every fifth prediction is off by one."""
    label = F.transform("words", lambda w, i: F.when((i + 1) % 4 == 0, -100).otherwise(F.length(w) % 7))
    guess = F.transform("words", lambda w, i: (F.length(w) + F.when((i + 1) % 5 == 0, 1).otherwise(0)) % 7)
    hits, counted = mt.masked_hits(label, guess)
    sums = fx.doc_words(t).select(hits.alias("h"), counted.alias("c")).agg(F.sum("h").alias("hits"), F.sum("c").alias("counted"))
    return sums.select("hits", "counted", r(F.col("hits") / F.col("counted")).alias("accuracy"))


def _summaries(t, pattern):
    """Reference: the text's words.  Prediction: every fifth one left out."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(0))
    rows = t.documents.select("doc_id", found.alias("ref"))
    return rows.withColumn("pred", F.filter("ref", lambda w, i: (i + 1) % 5 != 0))


ALNUM = "[a-z0-9]+"
# Words, and every punctuation mark on its own.
MARKS = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"


def _grams_sql(pattern, top):
    return f"""
s AS (SELECT doc_id, r, list_filter(r, lambda x, i: i % 5 <> 0) AS p FROM (SELECT doc_id, regexp_extract_all(lower(text), '{pattern}') AS r FROM documents)),
g AS (SELECT doc_id, n, side, array_to_string(w[i : i + n - 1], ' ') AS gram FROM (
        SELECT doc_id, n, side, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM (
          SELECT doc_id, 'p' AS side, p AS w FROM s UNION ALL SELECT doc_id, 'r', r FROM s), (SELECT unnest(generate_series(1, {top})) AS n))),
c AS (SELECT doc_id, n, gram, count(*) FILTER (side = 'p') AS cp, count(*) FILTER (side = 'r') AS cr FROM g GROUP BY ALL),
o AS (SELECT doc_id, n, sum(least(cp, cr)) AS common, sum(cp) AS n_pred, sum(cr) AS n_ref FROM c GROUP BY ALL)"""


@query(
    "q6_rouge_n",
    f"""WITH {_grams_sql(ALNUM, 2)}, d AS (SELECT s.doc_id, len(p) AS gen, n, coalesce(2.0::DOUBLE * common / nullif(n_pred + n_ref, 0), 0) AS f
        FROM (SELECT doc_id, p, unnest([1, 2]) AS n FROM s) s LEFT JOIN o USING (doc_id, n))
    SELECT {q.r('100 * avg(f) FILTER (n = 1)', 4)} AS rouge1, {q.r('100 * avg(f) FILTER (n = 2)', 4)} AS rouge2, {q.r('avg(gen)', 4)} AS gen_len FROM d""",
)
def rouge_n(t):
    rows = _summaries(t, ALNUM)
    overlap = durable(mt.ngram_overlap(rows, "doc_id", F.col("pred"), F.col("ref"), [1, 2]))
    f = mt.f_measure(F.col("common"), F.col("n_pred"), F.col("n_ref"))
    sums = overlap.agg(*[F.sum(F.when(F.col("n") == n, f)).alias(f"f{n}") for n in (1, 2)])
    # Words are the runs of one word, so the texts are not cut again for their lengths.
    texts = t.documents.agg(F.count("*").alias("rows"), F.count("text").alias("texts"))
    words = overlap.filter("n = 1").agg(F.coalesce(F.sum("n_pred"), F.lit(0)).alias("words"))
    sizes = texts.crossJoin(words).select("rows", F.try_divide("words", "texts").alias("gen_len")).first()
    return sums.select(
        r(100 * F.col("f1") / sizes["rows"], 4).alias("rouge1"),
        r(100 * F.col("f2") / sizes["rows"], 4).alias("rouge2"),
        r(F.lit(sizes["gen_len"]), 4).alias("gen_len"),
    )


@query("q6_rouge_l")
def rouge_l(t):
    """Longest common subsequence of the word arrays; the row-local part runs in Arrow batches."""
    rows = _summaries(t, ALNUM).withColumn("lcs", fuzzy.word_lcs("pred", "ref"))
    f = mt.f_measure(F.col("lcs"), F.size("pred"), F.size("ref"))
    return rows.agg(r(100 * F.avg(f), 4).alias("rouge_l"))


@query("q6_rouge_lsum")
def rouge_lsum(t):
    """ROUGE-Lsum by lines: common subsequences of a line with every predicted line, united; every fifth word of a line is left out."""
    lines = F.split(F.coalesce(F.lower("text"), F.lit("")), "\n")
    rows = t.documents.select(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(ALNUM), F.lit(0))).alias("ref"))
    rows = rows.withColumn("pred", F.transform("ref", lambda x: F.filter(x, lambda w, i: (i + 1) % 5 != 0)))
    f = mt.rouge_lsum(F.col("pred"), F.col("ref"))
    return rows.agg(r(100 * F.avg(f), 4).alias("rouge_lsum"))


@query(
    "q7_corpus_bleu",
    f"""WITH {_grams_sql(MARKS, 4)}, p AS (SELECT n, 100.0::DOUBLE * sum(common) / sum(n_pred) AS p FROM o GROUP BY n),
    l AS (SELECT sum(len(p))::DOUBLE AS h, sum(len(r))::DOUBLE AS r FROM s),
    b AS (SELECT CASE WHEN h < r THEN exp(1 - r / h) ELSE 1.0::DOUBLE END AS bp FROM l)
    SELECT {q.r('any_value(bp) * exp(sum(ln(p)) / 4)')} AS bleu, {q.r('any_value(bp)')} AS brevity_penalty,
           {', '.join(q.r(f'max(p) FILTER (n = {n})') + f' AS p{n}' for n in range(1, 5))} FROM p, b""",
)
def corpus_bleu(t):
    rows = _summaries(t, MARKS)
    overlap = durable(mt.ngram_overlap(rows, "doc_id", F.col("pred"), F.col("ref"), [1, 2, 3, 4]))
    words = [F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("n_pred", "hyp_len"), ("n_ref", "ref_len"))]
    sizes = overlap.filter("n = 1").agg(*words)
    return mt.bleu(overlap, sizes).select(*[r(c).alias(c) for c in ("bleu", "brevity_penalty", "p1", "p2", "p3", "p4")])


@query(
    "q8_perplexity",
    f"""WITH l AS (SELECT vec_id, unnest(generate_series(0, 63)) AS pos, -abs(unnest(embedding)::DOUBLE) * 5 AS lp FROM embeddings)
    SELECT vec_id, {q.r('sum(lp)')} AS log_prob, {q.r('-avg(lp)')} AS log_perplexity, {q.r('exp(-avg(lp))')} AS perplexity FROM l WHERE pos >= 10 GROUP BY vec_id""",
)
def perplexity(t):
    """Components stand for token log probabilities; the first ten belong to the prompt."""
    logps = F.transform("embedding", lambda x: -F.abs(x.cast("double")) * 5)
    rows = t.embeddings.select("vec_id", mt.sequence_log_probability(logps, 10).alias("s"), (F.size("embedding") - 10).alias("n"))
    mean = -F.col("s") / F.col("n")
    return rows.select("vec_id", r("s").alias("log_prob"), r(mean).alias("log_perplexity"), r(F.exp(mean)).alias("perplexity"))


@query(
    "q9_cross_entropy",
    f"""WITH l AS (SELECT vec_id, label, unnest(generate_series(0, 9)) AS c, unnest(embedding[1:10])::DOUBLE * 10 AS x FROM embeddings)
    SELECT vec_id, {q.r('ln(sum(exp(x))) - max(x) FILTER (c = label)')} AS loss FROM l GROUP BY vec_id""",
)
def cross_entropy(t):
    logits = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double") * 10)
    return t.embeddings.select("vec_id", r(mt.cross_entropy(vc.softmax(logits), F.col("label"))).alias("loss"))


@query(
    "q10_multiple_choice",
    f"SELECT count(*) FILTER (item_id % 4 = length(text) % 4) AS n_right, count(*) AS n, {q.r('100.0::DOUBLE * count(*) FILTER (item_id % 4 = length(text) % 4) / count(*)', 2)} AS percent FROM benchmark",
)
def multiple_choice(t):
    letters = F.lit(["A", "B", "C", "D"])
    at = lambda x: F.element_at(letters, (x % 4 + 1).cast("int"))
    right = at(F.col("item_id")) == at(F.length("text"))
    sums = t.benchmark.agg(F.count_if(right).alias("n_right"), F.count("*").alias("n"))
    return sums.select("n_right", "n", r(100.0 * F.col("n_right") / F.col("n"), 2).alias("percent"))


_LANGS = ["de", "en", "es", "fr"]


@query(
    "q11_score_matrix",
    f"""WITH s AS (SELECT trained_on, lang, ((doc_id * 7 + i * 13) % 100) / 100.0::DOUBLE AS score
                  FROM documents, (SELECT unnest({_LANGS}) AS trained_on, unnest([0, 1, 2, 3]) AS i))
    SELECT trained_on, {', '.join(q.r(f"avg(score) FILTER (lang = '{x}')", 4) + f' AS {x}' for x in _LANGS)} FROM s GROUP BY trained_on""",
)
def score_matrix(t):
    sides = F.array(*[F.struct(F.lit(x).alias("trained_on"), F.lit(i).alias("i")) for i, x in enumerate(_LANGS)])
    rows = t.documents.select("doc_id", "lang", F.explode(sides).alias("s")).select("doc_id", "lang", "s.*")
    scored = rows.withColumn("score", (F.col("doc_id") * 7 + F.col("i") * 13) % 100 / 100.0)
    return scored.groupBy("trained_on").pivot("lang", _LANGS).agg(F.round(F.avg("score"), 4))


@query(
    "q12_answer_span",
    """WITH s AS (SELECT vec_id, list_position(embedding, list_max(embedding)) AS a, list_position(embedding, list_min(embedding)) AS b FROM embeddings)
    SELECT vec_id, coalesce((SELECT string_agg('t' || (i - 1), ' ' ORDER BY i) FROM range(1, 65) r(i) WHERE i BETWEEN a AND b), '') AS answer FROM s""",
)
def answer_span(t):
    """Start scores are the components, end scores their negatives."""
    tokens = F.lit([f"t{i}" for i in range(64)])
    span = mt.answer_span(F.col("embedding"), F.transform("embedding", lambda x: -x), tokens)
    return t.embeddings.select("vec_id", F.array_join(span, " ").alias("answer"))


@query(
    "q13_repeated_ngrams",
    f"""WITH {fx.WORDS_SQL}, g AS (SELECT doc_id, list_transform(generate_series(1, n - 1), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM dw)
    SELECT doc_id, CASE WHEN len(g) > 0 THEN {q.r('len(list_distinct(g))::DOUBLE / len(g)')} END AS distinct_share FROM g WHERE len(g) > 0""",
)
def repeated_ngrams(t):
    rows = fx.doc_words(t).select("doc_id", r(mt.distinct_ngram_share(F.col("words"), 2)).alias("distinct_share"))
    return rows.dropna()
