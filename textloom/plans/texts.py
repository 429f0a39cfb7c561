"""Text cleaning, cutting and scoring as table jobs."""

from pyspark.sql import functions as F

from textloom.functions.stemming import stem_words
from textloom.functions import fuzzy
from textloom.functions import text as tx
from textloom.functions.encoding import repair_encoding
from textloom.operators import statistics as st
from textloom.operators import texts
from textloom.operators.prompts import turn_pairs
from textloom.plans import fixtures as fx
from textloom.plans import sqltext as q
from textloom.plans.registry import csv, query, r


def _job(t, cleaned):
    """Cleaned text with the number of characters it lost and whether it changed."""
    return t.documents.select(
        "doc_id",
        cleaned.alias("cleaned"),
        (F.length("text") - F.length(cleaned)).alias("chars_lost"),
        (cleaned != F.col("text")).alias("changed"),
    )


def _job_sql(cleaned, extra=""):
    return f"""{extra} SELECT doc_id, cleaned, (length(text) - length(cleaned))::INTEGER AS chars_lost, cleaned <> text AS changed
               FROM (SELECT doc_id, text, {cleaned} AS cleaned FROM documents)"""


def _quoted(s):
    return s.replace("'", "''")


_LYRIC_SQL = f"""translate(text, '{_quoted("".join(tx.LYRIC_LETTERS))}', '{_quoted("".join(tx.LYRIC_LETTERS.values()))}')"""
_LYRIC_SQL = f"""translate({_LYRIC_SQL}, '{"".join(tx.LYRIC_SPACES)}', '     ')"""
for _pattern in tx.LYRIC_REMOVALS:
    _LYRIC_SQL = q.strip(_LYRIC_SQL, _pattern.replace("(?md)^", ""))

_MARKUP_SQL = "text"
for _pattern, _new in tx.MARKUP:
    _MARKUP_SQL = q.strip(_MARKUP_SQL, _pattern.replace("\n", "\\n"), _new)

_NO_PUNCT = r"[^\p{L}\p{M}\p{N}_" + q.SPACE + "]"


@query("t1_character_map", _job_sql(_LYRIC_SQL))
def character_map(t):
    return _job(t, tx.map_characters(F.col("text"), tx.LYRIC_LETTERS, tx.LYRIC_SPACES, tx.LYRIC_REMOVALS))


@query("t2_lower_collapse", _job_sql(f"lower(array_to_string({q.words('text')}, ' '))"))
def lower_collapse(t):
    return _job(t, tx.lower_collapsed(F.col("text")))


@query("t3_punctuation_digits", _job_sql(q.strip(q.strip("text", _NO_PUNCT), r"\p{Nd}+")))
def punctuation_digits(t):
    return _job(t, tx.strip_digits(tx.strip_punctuation(F.col("text"))))


@query("t4_urls_mentions", _job_sql(q.strip(q.strip("text", f"http[^{q.SPACE}]+"), r"@[A-Za-z0-9]+\s?")))
def urls_mentions(t):
    return _job(t, tx.strip_mentions(tx.strip_urls(F.col("text"))))


@query(
    "t5_markup",
    f"""SELECT page_id, cleaned, (length(text) - length(cleaned))::INTEGER AS chars_lost, cleaned <> text AS changed
        FROM (SELECT page_id, text, {_MARKUP_SQL} AS cleaned FROM (SELECT page_id, html AS text FROM pages))""",
)
def markup(t):
    cleaned = tx.strip_markup(F.col("html"))
    lost = (F.length("html") - F.length(cleaned)).alias("chars_lost")
    return t.pages.select("page_id", cleaned.alias("cleaned"), lost, (cleaned != F.col("html")).alias("changed"))


_EMOJI_IN = "regexp_replace(regexp_replace(text, '\\.', ' ' || chr(128512) || chr(128640) || '.', 'g'), ',', chr(9829) || chr(9829), 'g')"


@query(
    "t6_emoji_hearts",
    f"""SELECT doc_id, regexp_replace(regexp_replace(marked, '{tx.EMOJI}', '', 'g'), '{tx.HEARTS}', ' **** ', 'g') AS cleaned
        FROM (SELECT doc_id, {_EMOJI_IN} AS marked FROM documents)""",
)
def emoji_hearts(t):
    """Emoji are put after sentences and hearts for commas, since the texts have none."""
    marked = F.regexp_replace(F.regexp_replace("text", r"\.", " \U0001f600\U0001f680."), ",", "♥♥")
    return t.documents.select("doc_id", tx.mask_hearts(tx.strip_emoji(marked)).alias("cleaned"))


@query("t7_collapse_blanks", _job_sql(q.strip("text", " +", " ")))
def collapse_blanks(t):
    return _job(t, tx.collapse_blanks(F.col("text")))


@query(
    "t8_stop_words",
    f"""WITH {fx.STOP_SQL}
        SELECT doc_id, array_to_string(list_filter(w, lambda x: NOT list_contains(l, lower(x))), ' ') AS kept
        FROM (SELECT doc_id, {q.words('text')} AS w FROM documents), (SELECT list(word) AS l FROM stop)""",
)
def stop_words(t):
    kept = texts.remove_stop_words(t.documents, tx.words(F.col("text")), fx.stop_words(t), "kept")
    return kept.select("doc_id", F.array_join("kept", " ").alias("kept"))


@query("t9_stems")
def stems(t):
    """Stems of the vocabulary, then of every text through the stem table."""
    words = tx.words(tx.strip_punctuation(F.lower("text")))
    vocabulary = t.documents.select(F.explode(words).alias("word")).distinct()
    stemmed = texts.replace_words(t.documents, "doc_id", words, texts.stem_table(vocabulary), "stems", fx.text_parts(t))
    return stemmed.select("doc_id", F.array_join("stems", " ").alias("stemmed"))


@query(
    "t10_lemmas",
    f"""WITH {fx.VOCABULARY_SQL},
        lemma AS (SELECT word, substr(word, 1, length(word) - 1) AS replacement FROM vocab WHERE word LIKE '%s' AND length(word) > 4),
        tok AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM (SELECT doc_id, {q.words('lower(text)')} AS w FROM documents)))
        SELECT doc_id, string_agg(coalesce(replacement, tok.word), ' ' ORDER BY i) AS lemmas FROM tok LEFT JOIN lemma ON tok.word = lemma.word GROUP BY doc_id""",
)
def lemmas(t):
    """A lemma table that drops a final s stands in for a dictionary."""
    listed = fx.vocabulary(t).filter(F.col("word").endswith("s") & (F.length("word") > 4))
    table = listed.select("word", F.expr("substr(word, 1, length(word) - 1)").alias("replacement"))
    mapped = texts.replace_words(t.documents, "doc_id", tx.words(F.lower("text")), table, "lemmas", fx.text_parts(t))
    return mapped.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@query(
    "t11_simple_tokens",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}_]+'),
               lambda x: length(x) BETWEEN 4 AND 15 AND x NOT LIKE '\\_%' ESCAPE '\\'), ' ') AS tokens FROM documents""",
)
def simple_tokens(t):
    return t.documents.select("doc_id", F.array_join(tx.simple_tokens(F.col("text")), " ").alias("tokens"))


_CLEAN_SQL = q.strip(q.strip(_MARKUP_SQL, tx.EMOJI), tx.HEARTS, " **** ")
_CLEAN_SQL = f"translate({q.strip(_CLEAN_SQL, chr(92) + 'p{Nd}+')}, '{tx.REVIEW_PUNCTUATION}', '')"


@query(
    "t12_cleaned_words",
    f"""WITH {fx.STOP_SQL}
        SELECT doc_id, array_to_string(list_filter(w, lambda x: NOT list_contains(l, x)), ' ') AS cleaned
        FROM (SELECT doc_id, {q.words(f'lower({_CLEAN_SQL})')} AS w FROM documents), (SELECT list(word) AS l FROM stop)""",
)
def cleaned_words(t):
    """The ordered cleaning steps and stop words in one projection; the words as they are."""
    kept = _cleaned(t)
    return kept.select("doc_id", tx.collapse_blanks(F.array_join("kept", " ")).alias("cleaned"))


@query("t12_full_cleaning")
def full_cleaning(t):
    """The ordered cleaning steps, stop words, and the stems of the words that stay."""
    stemmed = _cleaned(t).select("doc_id", stem_words("kept").alias("kept"))
    return stemmed.select("doc_id", tx.collapse_blanks(F.array_join("kept", " ")).alias("cleaned"))


def _cleaned(t):
    words = tx.words(F.lower(tx.clean_review(F.col("text"))))
    return texts.remove_stop_words(t.documents.select("doc_id", "text"), words, fx.stop_words(t), "kept")


@query(
    "t13_sentences",
    f"""SELECT doc_id, len(list_filter(s, lambda x: {q.word_count('x')} > 4))::INTEGER AS long_sentences,
               array_to_string(s[1:3], chr(10)) AS lead FROM (SELECT doc_id, {q.sentences('text')} AS s FROM documents)""",
)
def sentences(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id", F.size(tx.long_sentences(text)).alias("long_sentences"), tx.lead_summary(text).alias("lead")
    )


@query("t14_repair_encoding")
def encoding(t):
    """Texts are first garbled (UTF-8 bytes read as latin-1), then repaired."""
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.select("doc_id", repair_encoding(garbled).alias("repaired"))


_MARKED_SQL = "'### Instruction:' || chr(10) || question || chr(10) || '### Output:' || chr(10) || answer"


@query(
    "t15_between_markers",
    f"""WITH {q.PAIRS},
        m AS (SELECT conv_id, pair_turn, CASE WHEN pair_turn % 4 = 0 THEN question ELSE {_MARKED_SQL} END AS prompt FROM pairs)
        SELECT conv_id, pair_turn,
               CASE WHEN contains(prompt, '### Output:') THEN trim(split_part(split_part(prompt, '### Output:', 1), '### Instruction:', 2), E' \\t\\n\\r') END AS instruction,
               CASE WHEN contains(prompt, '### Output:') THEN trim(split_part(prompt, '### Output:', 2), E' \\t\\n\\r') END AS content,
               NOT contains(prompt, '### Output:') AS flagged FROM m""",
)
def between_markers(t):
    pairs = turn_pairs(t.conversations)
    marked = F.concat(F.lit("### Instruction:\n"), "question", F.lit("\n### Output:\n"), "answer")
    prompt = F.when(F.col("pair_turn") % 4 == 0, F.col("question")).otherwise(marked)
    parsed = pairs.withColumn("prompt", prompt).select(
        "conv_id",
        "pair_turn",
        tx.between_markers(F.col("prompt"), "### Instruction:", "### Output:").alias("instruction"),
        tx.between_markers(F.col("prompt"), "### Output:", None).alias("content"),
    )
    return parsed.withColumn("flagged", F.col("instruction").isNull() | F.col("content").isNull())


@query(
    "t16_strip_prompt",
    f"WITH {q.PAIRS} SELECT conv_id, pair_turn, replace(answer, '.', ' ') AS reply FROM pairs",
)
def strip_prompt(t):
    """Generated text = prompt + answer with newline marks for full stops + end mark."""
    generated = F.concat("question", F.replace(F.col("answer"), F.lit("."), F.lit("<n>")), F.lit("</s>"))
    pairs = turn_pairs(t.conversations)
    return pairs.select("conv_id", "pair_turn", tx.after_prompt(generated, F.col("question")).alias("reply"))


@query(
    "t17_json_island",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN props END AS island,
              CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END AS k,
              CASE WHEN event_type = 'view' THEN 'no object' END AS reason FROM events""",
)
def json_island(t):
    reply = F.when(F.col("event_type") == "view", "Sorry, nothing.").otherwise(
        F.concat(F.lit("Sure, here it is:\n"), "props", F.lit("\nAnything else?"))
    )
    island = tx.json_island(reply)
    parsed = F.get_json_object(F.col("island"), "$.k")
    found = t.events.select("event_id", island.alias("island"))
    reason = F.when(F.col("island").isNull(), "no object").when(parsed.isNull(), "not json")
    return found.select("event_id", "island", parsed.alias("k"), reason.alias("reason"))


@query(
    "t18_fixed_chunks",
    """SELECT doc_id, c::INTEGER AS chunk_no, substr(text, c * 500 + 1, 500) AS chunk FROM (
         SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 500)) AS c FROM documents WHERE length(text) > 0)""",
)
def fixed_chunks(t):
    return t.documents.select("doc_id", F.posexplode(tx.fixed_chunks(F.col("text"), 500)).alias("chunk_no", "chunk"))


@query(
    "t19_sentiment",
    f"""WITH {fx.LEXICON_SQL},
        tok AS (SELECT doc_id, unnest({q.words('lower(text)')}) AS word FROM documents),
        s AS (SELECT doc_id, sum(coalesce(score, 0))::DOUBLE AS s, avg((score > 0 AND score IS NOT NULL)::INTEGER) AS pos,
                     avg((score < 0 AND score IS NOT NULL)::INTEGER) AS neg FROM tok LEFT JOIN lex USING (word) GROUP BY doc_id),
        c AS (SELECT doc_id, pos, neg, s / sqrt(s * s + 15) AS compound FROM s)
        SELECT doc_id, {q.r('pos')} AS pos, {q.r('neg')} AS neg, {q.r('1 - pos - neg')} AS neu, {q.r('compound')} AS compound,
               CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS label FROM c""",
)
def sentiment(t):
    bags = st.bag_of_words(t.documents, "doc_id", tx.words(F.lower("text")))
    scored = texts.lexicon_scores(bags, fx.lexicon(t), "doc_id")
    return scored.select("doc_id", *[r(c).alias(c) for c in ("pos", "neg", "neu", "compound")], "label")


@query("t20_edit_ratio")
def edit_ratio(t):
    pairs = turn_pairs(t.conversations)
    score = r(fuzzy.ratio("question", "answer"), 4)
    return pairs.select("conv_id", "pair_turn", score.alias("ratio"))


@query("t21_partial_ratio")
def partial_ratio(t):
    pairs = turn_pairs(t.conversations)
    return pairs.select("conv_id", "pair_turn", r(fuzzy.partial_ratio("question", "answer"), 4).alias("partial_ratio"))


@query("t22_token_set_ratio")
def token_set_ratio(t):
    pairs = turn_pairs(t.conversations)
    return pairs.select("conv_id", "pair_turn", r(fuzzy.token_set_ratio("question", "answer"), 4).alias("token_set_ratio"))


@query("t23_weighted_ratio")
def weighted_ratio(t):
    pairs = turn_pairs(t.conversations)
    return pairs.select(
        "conv_id",
        "pair_turn",
        r(fuzzy.weighted_ratio("question", "answer"), 4).alias("w_ratio"),
        r(fuzzy.q_ratio("question", "answer"), 4).alias("q_ratio"),
    )


@query(
    "t24_jaro_winkler",
    f"""WITH {q.PAIRS}
        SELECT conv_id, pair_turn, {q.r('100 * jaro_winkler_similarity(lower(question), lower(answer))', 4)} AS jaro_winkler
        FROM (SELECT conv_id, pair_turn, regexp_replace(lower(question), '[^a-z ]', '', 'g') AS question,
                     regexp_replace(lower(answer), '[^a-z ]', '', 'g') AS answer FROM pairs)""",
)
def jaro_winkler(t):
    """On plain letters: the SQL function counts bytes."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z ]", "")
    pairs = turn_pairs(t.conversations)
    score = fuzzy.jaro_winkler(plain("question"), plain("answer"))
    return pairs.select("conv_id", "pair_turn", r(score, 4).alias("jaro_winkler"))


@query(
    "t25_hamming",
    """SELECT p_partkey, CASE WHEN length(p_name) = length(reverse(p_name)) THEN
              list_sum(list_transform(generate_series(1, length(p_name)), lambda i: (p_name[i] <> reverse(p_name)[i])::INTEGER))::BIGINT END AS distance
       FROM part""",
)
def hamming(t):
    reversed_name = F.reverse("p_name")
    return t.part.select("p_partkey", fuzzy.hamming(F.col("p_name"), reversed_name).alias("distance"))


@query(
    "t26_entity_sentences",
    f"""WITH {fx.GAZETTEER_SQL},
        s AS (SELECT doc_id, i - 1 AS sent_no, s[i] AS sentence FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM (SELECT doc_id, {q.sentences('text')} AS s FROM documents))),
        m AS (SELECT doc_id, sent_no, unnest({q.words('lower(sentence)')}) AS word FROM s)
        SELECT doc_id, sent_no::INTEGER AS sent_no, type, count(*) AS mentions, count(DISTINCT word) > 1 AS several
        FROM m JOIN gaz USING (word) GROUP BY doc_id, sent_no, type""",
)
def entity_sentences(t):
    found = texts.mentions(
        t.documents, "doc_id", tx.sentences(F.col("text")), fx.gazetteer(t), lambda s: tx.words(F.lower(s)), fx.text_parts(t)
    )
    counted = found.groupBy("doc_id", "sent_no", "type").agg(
        F.count("*").alias("mentions"), (F.min("word") != F.max("word")).alias("several")
    )
    return counted


@query(
    "t27_mention_indices",
    f"""WITH {fx.GAZETTEER_SQL},
        s AS (SELECT doc_id, i - 1 AS sent_no, {q.words('lower(s[i])')} AS w FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM (SELECT doc_id, {q.sentences('text')} AS s FROM documents))),
        p AS (SELECT doc_id, sent_no, w[i] AS word, i - 1 AS pos FROM (SELECT doc_id, sent_no, w, unnest(generate_series(1, len(w))) AS i FROM s)),
        m AS (SELECT doc_id, sent_no, type, pos, pos - row_number() OVER (PARTITION BY doc_id, sent_no, type ORDER BY pos) AS g FROM p JOIN gaz USING (word))
        SELECT doc_id, sent_no::INTEGER AS sent_no, type, min(pos)::INTEGER AS start_pos, (max(pos) + 1)::INTEGER AS end_pos,
               string_agg(pos::VARCHAR, ',' ORDER BY pos) AS indices FROM m GROUP BY doc_id, sent_no, type, g""",
)
def mention_indices(t):
    found = texts.mentions(
        t.documents, "doc_id", tx.sentences(F.col("text")), fx.gazetteer(t), lambda s: tx.words(F.lower(s)), fx.text_parts(t)
    )
    return texts.mention_runs(found, "doc_id").withColumn("indices", csv("indices"))


_DEP_SQL = f"""
    s AS (SELECT doc_id, i - 1 AS sent_no, {q.words('s[i]')} AS w FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM (SELECT doc_id, {q.sentences('text')} AS s FROM documents))),
    dep AS (SELECT doc_id, sent_no, i - 1 AS tok, w[i] AS text,
              CASE WHEN i <= 3 OR i % 2 = 0 THEN 1 ELSE i - 2 END AS head,
              CASE WHEN i = 1 THEN 'nsubj' WHEN i = 2 THEN 'ROOT' WHEN i = 3 THEN 'dobj' WHEN i % 2 = 0 THEN 'prep' ELSE 'pobj' END AS dep,
              CASE WHEN i = 2 THEN 'VERB' WHEN i % 2 = 0 THEN 'ADP' WHEN i = 3 AND length(w[i]) <= 3 THEN 'PRON' ELSE 'NOUN' END AS pos
            FROM (SELECT doc_id, sent_no, w, unnest(generate_series(1, len(w))) AS i FROM s))"""


@query(
    "t28_actions",
    f"""WITH {_DEP_SQL},
        v AS (SELECT doc_id, sent_no, text AS verb FROM dep WHERE dep = 'ROOT'),
        o AS (SELECT doc_id, sent_no, text AS phrase FROM dep WHERE dep = 'dobj' AND pos = 'NOUN'
              UNION ALL SELECT p.doc_id, p.sent_no, p.text || ' ' || c.text FROM dep p JOIN dep c
                ON p.doc_id = c.doc_id AND p.sent_no = c.sent_no AND c.head = p.tok AND p.dep = 'prep' AND c.dep = 'pobj')
        SELECT v.doc_id, v.sent_no::INTEGER AS sent_no, s.text || ' ' || verb || ' ' || phrase AS action
        FROM v JOIN dep s ON s.doc_id = v.doc_id AND s.sent_no = v.sent_no AND s.dep = 'nsubj'
        JOIN o ON o.doc_id = v.doc_id AND o.sent_no = v.sent_no""",
)
def actions(t):
    """A rule stands in for the parser: word 1 subject, 2 verb, 3 object, then prepositions and their objects in turn."""
    rows = t.documents.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("sent_no", "sentence"))
    tok = rows.select("doc_id", "sent_no", F.posexplode(tx.words(F.col("sentence"))).alias("tok", "text"))
    odd = F.col("tok") % 2 == 1
    named = tok.withColumns(
        {
            "head": F.when((F.col("tok") < 3) | odd, 1).otherwise(F.col("tok") - 1),
            "dep": F.when(F.col("tok") < 3, F.get(F.lit(["nsubj", "ROOT", "dobj"]), F.col("tok")))
            .when(odd, "prep")
            .otherwise("pobj"),
            "pos": F.when(F.col("tok") == 1, "VERB")
            .when(odd, "ADP")
            .when((F.col("tok") == 2) & (F.length("text") <= 3), "PRON")
            .otherwise("NOUN"),
        }
    )
    return texts.subject_verb_object(named).select("doc_id", "sent_no", "action")


# Forms of one pronoun lemma.
PRONOUNS = ["i", "you", "he", "she", "it", "we", "they", "that", "this", "il", "elle", "la", "le", "er", "sie", "es", "yo", "lo"]


@query(
    "t29_drop_pronouns",
    f"""SELECT doc_id, array_to_string(list_filter({q.words('text')}, lambda x: NOT list_contains({PRONOUNS}, lower(x))), ' ') AS kept FROM documents""",
)
def drop_pronouns(t):
    table = t.spark.createDataFrame([(w,) for w in PRONOUNS], "word string")
    kept = texts.remove_stop_words(t.documents, tx.words(F.col("text")), table, "kept")
    return kept.select("doc_id", F.array_join("kept", " ").alias("kept"))


@query(
    "t30_length_limits",
    f"""SELECT lang, {q.r('avg((n > 512)::INTEGER)')} AS over_512, {q.r('avg((n > 1024)::INTEGER)')} AS over_1024
        FROM (SELECT lang, {q.word_count('text')} AS n FROM documents) GROUP BY lang""",
)
def length_limits(t):
    text = F.col("text")
    shares = [r(F.avg(tx.words_share_over(text, n))).alias(f"over_{n}") for n in (512, 1024)]
    return t.documents.groupBy("lang").agg(*shares)
