"""Line-first quality rules, in DataFrame functions alone.

Each line is judged on its own: too little punctuation or too many symbols,
navigation, boilerplate. Failing lines go; a document that loses too much of
its text, or fails a base rule, is rejected. Every rule reads only its own row,
so nothing is shuffled and a hot source costs no more than any other.

A null text counts as empty: no words, so it fails the base rule. Lines without
a word are never judged. Repeated rows are judged alike. An empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WORD_SPACE

SYMBOLS = "#*$%&|<>"  # fixed values
WINDOW = 5
POSITION_BITS = 24  # of a word in its text; the other 40 bits of a sort key are of the window's hash
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "subscribe to our newsletter", "sign up for our newsletter", "enable javascript", "javascript is disabled",
    "click here to", "share this page", "accept all cookies",
)
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


def base_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("__text", text)
    words = F.filter(F.split("__text", _SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(_WORD))
    rows = rows.withColumn("__hash", F.transform(words, lambda w: F.xxhash64(w))).withColumn("__lines", lines)
    rows = rows.withColumn("n_words", F.size("__hash").cast("long"))
    n_windows = F.greatest(F.lit(0), F.size("__hash") - (WINDOW - 1))
    window = F.transform(
        F.slice("__hash", 1, n_windows),
        lambda h, i: F.xxhash64(h, *[F.get("__hash", i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.withColumn("__window", window)
    # Most texts repeat no window: only the others are sorted. A sort key is the window's hash, then its place.
    keys = F.transform(
        "__window", lambda h, i: F.shiftleft(F.shiftrightunsigned(h, POSITION_BITS), POSITION_BITS).bitwiseOR(i.cast("long"))
    )
    repeats = F.size(F.array_distinct("__window")) < F.size("__window")
    rows = rows.withColumn("__keys", F.when(repeats, F.sort_array(keys)))

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")

    def same(key: Column, other: Column) -> Column:
        return F.coalesce(F.get("__window", place(key)) == F.get("__window", place(other)), F.lit(False))

    twice = F.filter("__keys", lambda k, i: same(k, F.get("__keys", i + 1)) | same(k, F.get("__keys", i - 1)))
    places = F.sort_array(F.transform(twice, place))
    rows = rows.withColumn("__places", places)
    # Each place covers its window's words up to the next place.
    covered = F.aggregate(
        F.transform("__places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return (
        rows.withColumn("word_chars", F.length(F.translate("__text", WORD_SPACE, "")).cast("long"))
        .withColumn("n_symbols", (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        .drop("__text", "__hash", "__window", "__keys", "__places", "__lines")
    )


def line_fails(line: Column, symbol_share: float = 0.1, bars: int = 3) -> Column:
    """Navigation (`bars` or more separators), boilerplate, or more symbols and less punctuation than prose has.

    A line without a closing mark fails only if it has no letter or digit at
    all: headings and list items of clean texts end without one.
    """
    symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
    navigation = F.length(line) - F.length(F.translate(line, "|»›", "")) >= bars
    noise = symbols > symbol_share * F.length(F.translate(line, WORD_SPACE, ""))
    boilerplate = F.lower(line).rlike("|".join(BOILERPLATE))
    wordless = ~line.rlike(r"[\p{L}\p{N}]")
    return navigation | noise | boilerplate | wordless


def clean_lines(docs: DataFrame, most_lost: float = 0.5, **rules) -> DataFrame:
    """Add `clean_text` (lines that pass, joined), `lost_chars` and the method's verdict `line_kept`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(_WORD) | ~line_fails(x, **rules))
    rows = docs.withColumn("clean_text", F.array_join(kept, "\n"))
    lost = F.length(F.translate(text, WORD_SPACE, "")) - F.length(F.translate("clean_text", WORD_SPACE, ""))
    rows = rows.withColumn("lost_chars", lost.cast("long"))
    return rows.withColumn("line_kept", F.col("lost_chars") <= most_lost * F.length(F.translate(text, WORD_SPACE, "")))


def quality_rules(docs: DataFrame, least_words: int = 10, repeat_percent: int = 20, most_lost: float = 0.5) -> DataFrame:
    """`docs` with the base counts, `base_failed`, the cleaned text and `kept`."""
    rows = clean_lines(base_counts(docs), most_lost)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("line_kept"))


