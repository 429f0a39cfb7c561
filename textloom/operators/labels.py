"""Word, sub-word, tag and span alignment.

Tags travel as long tables `(doc, position, tag)`; words, tokens and spans of
a text as arrays in its row, so their size is that of one text. Runs along a
group are cut into blocks, so there a group may have any size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from textloom.functions.arrays import let
from textloom.operators.joins import RANGE_BUCKET, arrow_lists, contained, list_array, list_values, pairs_inside, texts_of, together
from textloom.operators.ordering import by_key, runs

IGNORE, NO_WORD = -100, -1


def _running_sums(lists: pa.Array) -> pa.Array:
    sizes, values, _ = list_values(lists)
    total = np.cumsum(values)
    before = np.concatenate([[0], total])[np.cumsum(sizes) - sizes]
    return list_array(sizes, pa.array(total - np.repeat(before, sizes), pa.int64()))


def word_offsets(
    df: DataFrame, key: str, words: Column, parts: int | None = None, beside: DataFrame | None = None
) -> DataFrame:
    """Words of every text with their character range in the text whose words are joined by one blank.

    One row a text, `(key, words)`: the fields `word_no`, `word`, `start_char` and `end_char` of `words` are equally long
    arrays. Rows with equal keys are one text, the words in order of their places. Texts are shuffled, words are not;
    `parts` is as in `ordering.by_key`. The columns of `beside`, a row a key at most, are added.
    """
    texts = by_key(df, [key], parts).groupBy(key).agg(F.collect_list(words).alias("__lists"))
    filled = texts.filter(F.exists("__lists", lambda x: F.size(x) > 0))
    others = [c for c in beside.columns if c != key] if beside is not None else []
    filled = filled if beside is None else filled.join(beside, key, "left")  # Python functions would hide how texts are dealt
    entry = lambda w, i: F.struct(i.alias("no"), w.alias("word"))
    merged = F.array_sort(F.flatten(F.transform("__lists", lambda x: F.transform(x, entry))))
    several, first = F.size("__lists") > 1, F.get("__lists", F.lit(0))
    listed = filled.select(
        key,
        *others,
        F.when(several, merged["no"]).otherwise(F.sequence(F.lit(0), F.size(first) - 1)).alias("no"),
        F.when(several, merged["word"]).otherwise(first).alias("word"),
    )
    sums = arrow_lists(_running_sums, ArrayType(LongType()))
    ends = listed.withColumn("until", sums(F.transform("word", lambda w: F.length(w) + 1)))
    start = F.zip_with("until", "word", lambda e, w: e - 1 - F.length(w))
    end = F.transform("until", lambda e: e - 1)
    placed = F.struct(F.col("no").alias("word_no"), "word", start.alias("start_char"), end.alias("end_char"))
    return ends.select(key, *others, placed.alias("words"))


def subword_rows(offsets: DataFrame, size: int) -> DataFrame:
    """Adds `pieces` of at most `size` characters of every word of `word_offsets`, with character ranges, as a struct of arrays.

    Stands in for a trained sub-word tokenizer: any arrays of token ranges can
    be used instead.
    """

    def cut(w):
        def piece(at):
            start = w["start_char"] + at
            return F.struct(
                w["word_no"].alias("word_no"),
                (at / size).cast("int").alias("piece_no"),
                F.substring(w["word"], at + 1, F.lit(size)).alias("token"),
                start.alias("tok_start"),
                F.least(start + size, w["end_char"]).alias("tok_end"),
            )

        return F.transform(F.sequence(F.lit(0), F.length(w["word"]) - 1, F.lit(size)), piece)

    names = ("word_no", "word", "start_char", "end_char")
    each = F.arrays_zip(*[F.col(f"words.{c}").alias(c) for c in names])
    rows = offsets.withColumn("__pieces", F.flatten(F.transform(each, cut)))
    fields = [F.col(f"__pieces.{c}").alias(c) for c in ("word_no", "piece_no", "token", "tok_start", "tok_end")]
    return rows.withColumn("pieces", F.struct(*fields)).drop("__pieces")


def token_word_map(texts: DataFrame, key: str) -> DataFrame:
    """Word index of each token from character ranges alone, -1 outside any word.

    `texts` has a row a text with its `words` as of `word_offsets` and its `tokens`, a struct of arrays with `tok_start` and `tok_end`.
    """
    words = F.col("words")
    spans = F.struct(words["word_no"].alias("word_no"), words["start_char"].alias("span_start"), words["end_char"].alias("span_end"))
    placed = contained(F.col("tokens"), spans, key, how="left", rows=texts).drop("span_start", "span_end")
    return placed.withColumn("word_no", F.coalesce("word_no", F.lit(NO_WORD)))


def bio_tags(sizes: DataFrame, spans: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """`B-`/`I-` tag of every word of the texts in `sizes(key, n_words)`, `O` outside spans.

    Where spans overlap, the later span (by start, then end) wins.  A text's
    spans travel as one array; its words are numbered after that join, so the
    word rows are already partitioned by text and are not shuffled. `parts` is
    as in `ordering.by_key`.
    """
    spans = spans if parts is None else by_key(spans, [key], parts)
    bundled = spans.groupBy(key).agg(F.collect_list(F.struct("start_word", "end_word", "class")).alias("spans"))
    joined = by_key(sizes, [key], parts).join(bundled, key, "left")

    def entry(word, start, end, tag):
        return F.struct(
            word.cast("int").alias("word_no"), start.cast("int").alias("s"), end.cast("int").alias("e"), tag.alias("tag")
        )

    def covered(s):
        def one(i):
            part = F.when(i == s["start_word"], "B-").otherwise("I-")
            return entry(i, s["start_word"], s["end_word"], F.concat(part, s["class"]))

        return F.transform(F.sequence(s["start_word"], s["end_word"]), one)

    none = F.lit(-1)
    plain = F.transform(F.sequence(F.lit(0), F.col("n_words") - 1), lambda i: entry(i, none, none, F.lit("O")))
    in_spans = F.coalesce(F.flatten(F.transform("spans", covered)), F.array())
    rows = joined.select(key, F.explode(F.concat(plain, in_spans)).alias("r")).select(key, "r.*")
    return rows.groupBy(key, "word_no").agg(F.max_by("tag", F.struct("s", "e", "tag")).alias("tag"))


def tag_spans(tags: DataFrame, key: str, pos: str = "word_no", min_words: int = 1) -> DataFrame:
    """Runs of one class as spans; a `B-` always starts a new one."""
    marked = tags.withColumn("class", F.regexp_replace("tag", "^[BI]-", ""))
    found = runs(marked, [key], pos, "class", opens=F.col("tag").startswith("B-")).filter("class <> 'O'")
    spans = found.select(key, "class", F.col("start").alias("start_word"), F.col("end").alias("end_word"))
    return spans.filter(F.col("end_word") - F.col("start_word") + 1 >= min_words)


def equal_runs(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Gaps and islands: maximal runs of equal values along `pos`."""
    found = runs(df, [key], pos, value)
    return found.select(
        key, value, F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), F.col("n").alias("run_length")
    )


def align_labels(word_ids: Column, labels: Column, all_pieces: bool = False) -> Column:
    """Label of each sub-word from its word's label.

    A null or -1 word id (a special token) gets -100; so do later pieces of a
    word unless `all_pieces`.
    """

    def align(both):
        ids, names = both["ids"], both["labels"]
        before = F.concat(F.array(F.lit(NO_WORD)), F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0))))

        def label(now, previous):
            special = now.isNull() | (now == NO_WORD)
            repeated = F.lit(False) if all_pieces else now.eqNullSafe(previous)
            return F.when(special | repeated, F.lit(IGNORE)).otherwise(F.get(names, now))

        return F.zip_with(ids, before, label)

    return let(F.struct(word_ids.alias("ids"), labels.alias("labels")), align)


def _targets(*lists: pa.Array) -> pa.Array:
    """Codes for the tokens of texts from the lists `tok_start, tok_end, span_start, span_end, class code`; null outside spans."""
    point, span, p_sizes, s_sizes = pairs_inside(lists[:2], lists[2:4], RANGE_BUCKET)
    tok_start, span_start = list_values(lists[0])[1][point], list_values(lists[2])[1][span]
    code, known = (x[span] for x in list_values(lists[4])[1:])
    # Spans of a text that start together have one first token.
    order = np.lexsort((tok_start, span_start, texts_of(p_sizes)[point]))
    group = np.stack([texts_of(p_sizes)[point], span_start])[:, order]
    new = np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(axis=0)])[: len(order)]
    first = np.empty_like(tok_start)
    first[order] = tok_start[order][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else tok_start
    target = 2 * code + (tok_start != first)
    # The latest span of a token decides.
    by_token = np.lexsort((target, known, span_start, point))
    last = by_token[np.flatnonzero(np.append(point[by_token][1:] != point[by_token][:-1], True)[: len(point)])]
    found, inside = np.zeros(p_sizes.sum(), np.int64), np.zeros(p_sizes.sum(), bool)
    found[point[last]], inside[point[last]] = target[last], known[last]
    return list_array(p_sizes, pa.array(found, pa.int64(), mask=~inside))


def char_span_targets(
    tokens: DataFrame | Column, spans: DataFrame | Column, key: str, classes: Sequence[str], parts: int | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Class code of each token: 2k opens a span of class k, 2k+1 continues it, 2n outside.

    Where several spans hold a token, the latest one decides. Tokens and spans of a text meet as arrays; `parts` and
    `rows` are as in `joins.contained`, the tokens of one of `rows` differ.
    """
    both = together(tokens, spans, key, "left", parts, rows, F.collect_set)
    names = F.lit(list(classes))
    codes = F.transform("__s.class", lambda c: (F.array_position(names, c) - 1).cast("bigint"))
    ranges = [F.col(c).cast("array<bigint>") for c in ("__p.tok_start", "__p.tok_end", "__s.span_start", "__s.span_end")]
    found = both.withColumn("__found", arrow_lists(_targets, ArrayType(LongType()))(*ranges, codes))
    fields = both.schema["__p"].dataType.names
    each = F.arrays_zip(*[F.col(f"__p.`{c}`").alias(c) for c in fields], F.col("__found").alias("target"))
    coded = found.select(key, F.inline(each))
    return coded.withColumn("target", F.coalesce("target", F.lit(2 * len(classes)).cast("bigint")))


def one_hot(code: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (i == code).cast("int"))


def drop_ignored(labels: Column, names: Column) -> Column:
    """Names of the labels, positions marked -100 left out."""
    kept = F.filter(labels, lambda x: x != IGNORE)
    return F.transform(kept, lambda x: F.get(names, x))


def first_prediction(rows: DataFrame, key: str) -> DataFrame:
    """One prediction per word from overlapping chunks: the earliest chunk wins, then the earliest position."""
    kept = rows.filter(F.col("word_no") != NO_WORD)
    first = F.min_by("label", F.struct("chunk_no", "pos"))
    return kept.groupBy(key, "word_no").agg(first.alias("label"))


def word_label_mismatch(df: DataFrame, words: Column, labels: Column) -> DataFrame:
    """Rows whose word and label counts differ."""
    counted = df.withColumns({"n_words": F.size(words), "n_labels": F.size(labels)})
    return counted.filter("n_words <> n_labels")
