"""Operators that relate words of a text to other tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.stemming import porter_stem
from textloom.functions.text import without_words
from textloom.operators.joins import salted_lookup
from textloom.operators.ordering import by_key

LIST_LIMIT = 100_000


def word_rows(df: DataFrame, key: str, words: Column, pos: str = "pos", word: str = "word") -> DataFrame:
    """One row per word with its position; a text without words keeps one empty row."""
    return df.select(key, F.posexplode_outer(words).alias(pos, word))


def gather_words(rows: DataFrame, key: str, value: str, out: str, pos: str = "pos") -> DataFrame:
    """Arrays of `value` in position order; null values are left out."""
    kept = F.collect_list(F.when(F.col(value).isNotNull(), F.struct(pos, value)))
    return rows.groupBy(key).agg(F.transform(F.array_sort(kept), lambda s: s[value]).alias(out))


def remove_stop_words(df: DataFrame, words: Column, stop: DataFrame, out: str, limit: int = LIST_LIMIT) -> DataFrame:
    """Drop words listed in `stop(word)`, compared in lower case; a null stays null.

    The list becomes a hash set inside the expression, so no text is shuffled
    and rows stay as they are. A list of more than `limit` words is an error.
    """
    listed = [row.word for row in stop.select("word").distinct().limit(limit + 1).collect()]
    if len(listed) > limit:
        raise ValueError(f"more than {limit} stop words; raise limit if the driver and the tasks can hold them")
    return df.withColumn(out, without_words(words, listed))


def replace_words(
    df: DataFrame, key: str, words: Column, mapping: DataFrame, out: str, parts: int | None = None
) -> DataFrame:
    """Replace each word by `mapping(word, replacement)`, keeping unknown words.

    The texts are partitioned by key once; with a broadcast mapping the words
    are gathered again without another shuffle. With `parts`, words alone are
    shuffled, into as many partitions, so that tasks sort them in memory. Words that make up much of the
    corpus are dealt over many tasks (`joins.salted_lookup`).
    """
    rows = word_rows(df.repartition(key) if parts is None else df, key, words)
    mapped = salted_lookup(rows, mapping, "word", [key, "pos"], parts=parts)
    mapped = mapped if parts is None else by_key(mapped, [key], parts)
    mapped = mapped.withColumn("word", F.coalesce("replacement", "word"))
    return gather_words(mapped, key, "word", out)


def stem_table(vocabulary: DataFrame) -> DataFrame:
    """Stems of a `(word)` table; Python sees each distinct word once."""
    return vocabulary.select("word").distinct().withColumn("replacement", porter_stem("word"))


def mentions(
    df: DataFrame, key: str, sentence_array: Column, gazetteer: DataFrame, word_array, parts: int | None = None
) -> DataFrame:
    """Words listed in `gazetteer(word, type)` with sentence number and position.

    Rows of words have `parts` partitions, if given, and so have those found, by sentence.
    """
    sentence_rows = df.select(key, F.posexplode(sentence_array).alias("sent_no", "sentence"))
    tokens = sentence_rows.select(key, "sent_no", F.posexplode(word_array(F.col("sentence"))).alias("pos", "word"))
    found = salted_lookup(tokens, gazetteer, "word", [key, "sent_no", "pos"], how="inner", parts=parts)
    found = found.select(key, "sent_no", "pos", "type", "word")
    return found if parts is None else by_key(found, [key, "sent_no"], parts)


def mention_runs(found: DataFrame, key: str) -> DataFrame:
    """Join neighbouring words of one type into spans and list their word indices."""
    from pyspark.sql import Window

    spot = Window.partitionBy(key, "sent_no", "type").orderBy("pos")
    runs = found.withColumn("__run", F.col("pos") - F.row_number().over(spot))
    spans = runs.groupBy(key, "sent_no", "type", "__run").agg(
        F.min("pos").alias("start_pos"), (F.max("pos") + 1).alias("end_pos")
    )
    return spans.drop("__run").withColumn("indices", F.sequence(F.col("start_pos"), F.col("end_pos") - 1))


def subject_verb_object(dependencies: DataFrame) -> DataFrame:
    """Actions of each sentence's root verb.

    `dependencies` has one row per word: `(doc_id, sent_no, tok, head, dep, pos, text)`.
    Direct objects must be nouns; prepositional objects come with their preposition.
    """
    sentence = ["doc_id", "sent_no"]
    nouns = F.col("pos").isin("NOUN", "PROPN")
    verbs = dependencies.filter((F.col("pos") == "VERB") & (F.col("dep") == "ROOT")).select(
        *sentence, F.col("tok").alias("verb_tok"), F.col("text").alias("verb")
    )

    def child(dep, name, condition=None):
        rows = dependencies.filter(F.col("dep") == dep)
        if condition is not None:
            rows = rows.filter(condition)
        return rows.select(
            *sentence,
            F.col("head").alias("verb_tok"),
            F.col("tok").alias(f"{name}_tok"),
            F.col("text").alias(name),
        )

    subjects = child("nsubj", "subject")
    direct = child("dobj", "object", nouns).withColumn("preposition", F.lit(""))
    preps = child("prep", "preposition")
    pobj = dependencies.filter(nouns).select(
        *sentence, F.col("head").alias("preposition_tok"), F.col("tok").alias("object_tok"), F.col("text").alias("object")
    )
    indirect = preps.join(pobj, [*sentence, "preposition_tok"]).drop("preposition_tok")
    objects = direct.unionByName(indirect)
    on_verb = [*sentence, "verb_tok"]
    return (
        verbs.join(subjects, on_verb)
        .join(objects, on_verb)
        .select(
            *sentence, "verb_tok", "subject_tok", "object_tok",
            F.concat_ws(
                " ", "subject", "verb", F.when(F.col("preposition") != "", F.col("preposition")), "object"
            ).alias("action"),
        )
    )


def lexicon_scores(bags: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """Sentiment shares and compound score of each text from `bags(key, word, tf)`.

    compound = s / sqrt(s^2 + 15) over the summed word scores; labels cut at 0.05.
    """
    joined = bags.join(lexicon, "word", "left")
    score, tf = F.coalesce("score", F.lit(0)), F.col("tf")
    sums = joined.groupBy(key).agg(
        F.sum(score * tf).cast("double").alias("s"),
        F.sum(F.when(score > 0, tf).otherwise(0)).alias("p"),
        F.sum(F.when(score < 0, tf).otherwise(0)).alias("m"),
        F.sum(tf).alias("n"),
    )
    compound = F.col("s") / F.sqrt(F.col("s") * F.col("s") + 15)
    label = F.when(compound >= 0.05, "Positive").when(compound <= -0.05, "Negative").otherwise("Neutral")
    return sums.select(
        key,
        (F.col("p") / F.col("n")).alias("pos"),
        (F.col("m") / F.col("n")).alias("neg"),
        (1 - F.col("p") / F.col("n") - F.col("m") / F.col("n")).alias("neu"),
        compound.alias("compound"),
        label.alias("label"),
    )
