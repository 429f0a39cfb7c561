"""Joins and lookups."""

from pyspark.sql import functions as F

from textloom.functions.text import words
from textloom.operators import fuzzyjoin, joins, neighbours
from textloom.operators.prompts import preference_pairs, turn_pairs
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query, r
from textloom.sources.scratch import durable


@query(
    "j1_full_outer",
    """
    WITH p AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS class, 'q' || toxic AS pred FROM labels),
    g AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'good' ELSE 'bad' END AS class, lang AS gt FROM documents)
    SELECT coalesce(p.doc_id, g.doc_id) AS doc_id, coalesce(p.class, g.class) AS class,
           coalesce(pred, ' ') AS pred, coalesce(gt, ' ') AS gt
    FROM p FULL OUTER JOIN g ON p.doc_id = g.doc_id AND p.class = g.class
    """,
)
def full_outer(t):
    predicted = t.labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("class"),
        F.concat(F.lit("q"), "toxic").alias("pred"),
    )
    truth = t.documents.select(
        "doc_id", F.when(F.col("n_chars") > 1000, "good").otherwise("bad").alias("class"), F.col("lang").alias("gt")
    )
    return joins.outer_with_blanks(predicted, truth, ["doc_id", "class"], ["pred", "gt"])


@query(
    "j2_label_lookup",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def label_lookup(t):
    """Dictionary tables carry no hint: Spark broadcasts them when their measured size allows it."""
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", "n_name", "r_name")


@query(
    "j3_word_vectors_default",
    f"""
    WITH {fx.VOCABULARY_SQL.replace('vocab AS (', 'vocab AS MATERIALIZED (')},
    known AS MATERIALIZED (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1e6)::BIGINT), ',') AS millionths FROM embeddings),
    place AS MATERIALIZED (SELECT word, h % (SELECT count(*) FROM embeddings) AS vec_id FROM (SELECT word, {q.hash_key('word', 7)} AS h FROM vocab) WHERE h % 10 <> 0),
    uses AS MATERIALIZED (SELECT vec_id, count(*) AS n FROM place GROUP BY vec_id),
    m AS MATERIALIZED (SELECT string_agg(round(mean * 1e6)::BIGINT::VARCHAR, ',' ORDER BY i) AS millionths FROM (
           SELECT i, sum(embedding[i]::DOUBLE * n) / sum(n) AS mean FROM embeddings JOIN uses USING (vec_id), generate_series(1, 64) AS g(i) GROUP BY i))
    SELECT v.word, p.word IS NOT NULL AS known, coalesce(k.millionths, m.millionths) AS millionths
    FROM vocab v LEFT JOIN place p ON p.word = v.word LEFT JOIN known k ON k.vec_id = p.vec_id, m
    """,
)
def word_vectors_default(t):
    """Whole vectors, as whole millionths so that engines compare them exactly."""
    vectors = durable(fx.word_vectors(t))  # a stored table as a rule; read twice here
    found = joins.vectors_with_default(fx.vocabulary(t).select("word"), vectors)
    parts = F.transform("vec", lambda x: F.round(x * 1e6).cast("bigint"))
    return found.select("word", "known", csv(parts).alias("millionths"))


@query(
    "j4_semi_anti",
    """
    SELECT doc_id, 'labelled' AS kind FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'open' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def semi_anti(t):
    ids, labelled = t.documents.select("doc_id"), t.labels.select("doc_id")
    known = ids.join(labelled, "doc_id", "left_semi").withColumn("kind", F.lit("labelled"))
    return known.unionByName(ids.join(labelled, "doc_id", "left_anti").withColumn("kind", F.lit("open")))


@query(
    "j5_document_spans",
    f"""
    WITH {fx.SPANS_SQL}
    SELECT d.doc_id, d.lang, k, class, array_to_string(w[start_word + 1 : end_word + 1], ' ') AS discourse_text
    FROM gold JOIN dw USING (doc_id) JOIN documents d USING (doc_id)
    """,
)
def document_spans(t):
    docs = t.documents.select("doc_id", "lang", words(F.col("text")).alias("words"))
    return joins.attach_spans(docs, fx.gold_spans(t), "doc_id", ["lang"]).select("doc_id", "lang", "k", "class", "discourse_text")


@query(
    "j6_tokens_in_spans",
    f"""
    WITH {fx.SPANS_SQL}
    SELECT doc_id, unnest(generate_series(start_word, end_word))::INTEGER AS word_no, k, class FROM gold
    """,
)
def tokens_in_spans(t):
    texts, words = fx.char_spans(t, fx.row_parts(t)), F.col("words")
    points = F.struct(words["word_no"].alias("word_no"), words["start_char"].alias("tok_start"), words["end_char"].alias("tok_end"))
    return joins.contained(points, F.col("spans"), "doc_id", rows=texts).select("doc_id", "word_no", "k", "class")


@query(
    "j7_query_similarity",
    """
    WITH z AS (SELECT embedding AS qv FROM embeddings ORDER BY vec_id LIMIT 1)
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], qv::DOUBLE[]), 6) AS cosine FROM embeddings, z
    """,
)
def query_similarity(t):
    first = t.embeddings.orderBy("vec_id").select("embedding").first()[0]
    return joins.similarity_to(t.embeddings, "embedding", first).select("vec_id", r("cosine").alias("cosine"))


def _neighbours_sql(queries: str) -> str:
    return f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT a.vec_id, b.vec_id AS neighbour, list_cosine_similarity(a.v, b.v) AS cosine
          FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE {queries})
    SELECT vec_id, rank, neighbour, {q.r('cosine')} AS cosine FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(cosine, 9) DESC, neighbour)::INTEGER AS rank FROM s) WHERE rank <= 5
    """


def _vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def _neighbour_rows(found):
    return found.select(F.col("id").alias("vec_id"), "rank", "neighbour", r("cosine").alias("cosine"))


@query("j8_top_neighbours", _neighbours_sql("true"))
def top_neighbours(t):
    """Every row's five nearest; a table that fits one leaf is compared whole, so the SQL gives the same rows."""
    return _neighbour_rows(neighbours.nearest_rows(_vectors(t), 5))


@query("j8_exact_neighbours", _neighbours_sql("a.vec_id % 20 = 0"))
def exact_neighbours(t):
    """A stated query set, every twentieth id, against all rows in blocks."""
    rows = _vectors(t)
    return _neighbour_rows(neighbours.nearest_exact(rows.filter(F.col("id") % 20 == 0), rows, 5))


@query(
    "j9_scored_join",
    f"""SELECT p_partkey, {q.r('100 * jaro_winkler_similarity(p_name, listed)', 4)} AS jaro_winkler,
           CASE WHEN length(p_name) = length(listed) THEN hamming(p_name, listed)::BIGINT END::VARCHAR AS distance
    FROM part JOIN (SELECT p_brand, min(p_name) AS listed FROM part GROUP BY p_brand) USING (p_brand)""",
)
def scored_join(t):
    """Part names against one listed name per brand; the brand is the block."""
    listed = t.part.groupBy("p_brand").agg(F.min("p_name").alias("listed"))
    scored = joins.scored_join(t.part.select("p_partkey", "p_brand", "p_name"), listed, ["p_brand"], "p_name", "listed")
    return scored.select("p_partkey", r("jaro_winkler", 4).alias("jaro_winkler"), F.col("distance").cast("string").alias("distance"))


_NAMES_SQL = """WITH n AS (SELECT p_name AS value, min(p_partkey) AS id, count(*) AS n FROM part GROUP BY p_name),
    l AS (SELECT a.id AS a, b.id AS b, a.value AS a_value, b.value AS b_value, b.n, levenshtein(a.value, b.value)::INTEGER AS distance
          FROM n a JOIN n b ON a.id <> b.id AND levenshtein(a.value, b.value) <= 3)"""


@query("j9_fuzzy_pairs", f"{_NAMES_SQL} SELECT a, b, a_value, b_value, distance FROM l WHERE a < b")
def fuzzy_pairs(t):
    """Different part names at most three edits apart; a name stands for its parts."""
    return fuzzyjoin.fuzzy_pairs(fuzzyjoin.classes(t.part, "p_partkey", "p_name"), 3)


@query(
    "j9_fuzzy_join",
    f"""{_NAMES_SQL}, s AS (SELECT a, sum(n) AS others FROM l GROUP BY a)
    SELECT p_partkey, id AS class_id, (n - 1 + coalesce(others, 0))::BIGINT AS links
    FROM part JOIN n ON p_name = value LEFT JOIN s ON s.a = id""",
)
def fuzzy_join(t):
    """Every part with its name's class and the number of other parts whose names are at most three edits away."""
    return fuzzyjoin.fuzzy_links(t.part, "p_partkey", "p_name", 3)


@query(
    "j10_preference_pairs",
    f"""
    WITH {q.PAIRS}
    SELECT conv_id, pair_turn, question AS prompt, answer AS chosen, reverse(answer) AS rejected FROM pairs
    """,
)
def preference_join(t):
    pairs, key = turn_pairs(t.conversations), ["conv_id", "pair_turn"]
    sides = F.array(
        F.struct(F.lit("strong").alias("model"), F.col("answer").alias("answer")),
        F.struct(F.lit("weak").alias("model"), F.reverse("answer").alias("answer")),
    )
    answers = pairs.select(*key, F.col("question").alias("prompt"), F.explode(sides).alias("s")).select(*key, "prompt", "s.*")
    return preference_pairs(answers, key, "strong", "weak")


@query(
    "j11_fold_ensemble",
    f"""
    WITH f AS (SELECT vec_id, fold, embedding[fold + 1]::DOUBLE * 10 AS cohesion, embedding[fold + 11]::DOUBLE * 10 AS syntax
               FROM embeddings, (SELECT unnest([0, 1, 2, 3, 4]) AS fold))
    SELECT vec_id, {q.r('sum(cohesion / 5)', 1)} AS cohesion, {q.r('sum(syntax / 5)', 1)} AS syntax FROM f GROUP BY vec_id
    """,
)
def fold_ensemble(t):
    folds = F.sequence(F.lit(0), F.lit(4))
    rows = t.embeddings.select("vec_id", "embedding", F.explode(folds).alias("fold"))
    scores = rows.select(
        "vec_id",
        (F.get("embedding", F.col("fold")).cast("double") * 10).alias("cohesion"),
        (F.get("embedding", F.col("fold") + 10).cast("double") * 10).alias("syntax"),
    )
    return joins.fold_ensemble(scores, "vec_id", ["cohesion", "syntax"], 5)
