"""Text cleaning and cutting as column expressions.

Patterns use explicit Unicode classes: Java's ``\\w`` and ``\\s`` are ASCII, and
documents come in several languages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that separates words: ASCII and Unicode spaces, NEL and the
# separators U+001C..U+001F.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WORD = rf"[^{SPACE}]+"

# Character clean-up of lyric text.
LYRIC_LETTERS = {
    "í": "i", "é": "e", "ï": "i", "ó": "o", ";": ",", "\u2018": "'", "\u2019": "'", ":": ",", "\u0435": "e",
}
LYRIC_SPACES = ["\u2005", "\u200b", "\u205f", "\xa0", "-"]
LYRIC_REMOVALS = [r"\)", r"\(", "–", '"', "”", r"\[[^\n]*\]", r"(?md)^[^\n]*\|[^\n]*", "—"]

# Review mark-up, applied in this order.
MARKUP = [
    (r"<a[^>]*>([^\n]+?)</a>", "Link."),
    ("&gt;", ""),
    ("&#x27;", "'"),
    ("&quot;", '"'),
    ("&#x2F;", " "),
    ("<p>", " "),
    ("</i>", ""),
    ("&#62;", ""),
    ("<i>", " "),
    ("\n", ""),
]

# Emoji blocks (emoticons, pictographs, transport, flags).
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+"
HEARTS = "[♥]+"

# Punctuation dropped from reviews.
REVIEW_PUNCTUATION = '?.;:!",'

NOT_WORD_OR_SPACE = rf"[^\p{{L}}\p{{M}}\p{{N}}_{SPACE}]"


def words(text: Column) -> Column:
    """Split on any run of white space; empty text gives no words."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def space_parts(text: Column) -> Column:
    """Split on every single blank, so doubled blanks leave empty parts."""
    return F.split(text, " ", -1)


def lower_collapsed(text: Column) -> Column:
    return F.lower(F.array_join(words(text), " "))


def map_characters(
    text: Column,
    letters: dict[str, str],
    to_space: Sequence[str],
    removals: Sequence[str],
) -> Column:
    """Translate letters, then blank out strings, then delete patterns, in that order."""
    out = F.translate(text, "".join(letters), "".join(letters.values()))
    out = F.translate(out, "".join(to_space), " " * len(to_space))
    for pattern in removals:
        out = F.regexp_replace(out, pattern, "")
    return out


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, NOT_WORD_OR_SPACE, "")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}+", "")


def strip_listed(text: Column, characters: str = REVIEW_PUNCTUATION) -> Column:
    return F.translate(text, characters, "")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"http[^{SPACE}]+", "")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, r"@[A-Za-z0-9]+\s?", "")


def strip_markup(text: Column) -> Column:
    for pattern, replacement in MARKUP:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def strip_emoji(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI, "")


def mask_hearts(text: Column) -> Column:
    return F.regexp_replace(text, HEARTS, " **** ")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def without_words(word_array: Column, stop: Sequence[str], ignore_case: bool = True) -> Column:
    """Drop listed words; the list becomes a hash set inside the expression."""
    probe = F.lower if ignore_case else (lambda w: w)
    return F.filter(word_array, lambda w: ~probe(w).isin(list(stop)))


def simple_tokens(text: Column, min_len: int = 4, max_len: int = 15) -> Column:
    """Lower-case runs of letters whose length lies in the given range."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}_]+"), F.lit(0))
    return F.filter(runs, lambda w: (F.length(w) >= min_len) & (F.length(w) <= max_len) & ~w.startswith("_"))


def clean_review(text: Column) -> Column:
    """Mark-up, emoji, hearts, numbers and listed punctuation, in that order."""
    return strip_listed(strip_digits(mask_hearts(strip_emoji(strip_markup(text)))))


def sentences(text: Column) -> Column:
    """Cut after `.`, `!` or `?` followed by white space."""
    return F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\x01"), "\x01", -1)


def long_sentences(text: Column, min_words: int = 5) -> Column:
    return F.filter(sentences(text), lambda s: word_count(s) >= min_words)


def lead_summary(text: Column, count: int = 3) -> Column:
    return F.array_join(F.slice(sentences(text), 1, count), "\n")


def between_markers(text: Column, start: str, end: str | None) -> Column:
    """Text after `start` and before `end`, stripped; null when a marker is missing."""
    at = F.instr(text, start)
    if end is None:
        stop, missing = F.length(text) + 1, at == 0
    else:
        stop = F.instr(text, end)
        missing = (at == 0) | (stop == 0)
    first = at + len(start)
    body = F.substring(text, first, F.greatest(stop - first, F.lit(0)))
    return F.when(~missing, F.regexp_replace(body, r"^\s+|\s+$", ""))


def after_prompt(generated: Column, prompt: Column) -> Column:
    """Drop a leading prompt by length, then end and newline marks."""
    rest = F.substring(generated, F.length(prompt) + 1, F.length(generated))
    return F.replace(F.replace(rest, F.lit("</s>"), F.lit("")), F.lit("<n>"), F.lit(" "))


def json_island(text: Column) -> Column:
    """From the first `{` to the last `}`; null when there is none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def fixed_chunks(text: Column, size: int) -> Column:
    """Consecutive pieces of `size` characters, the last one short."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size))
    pieces = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) > 0, pieces).otherwise(F.array().cast("array<string>"))


def https_links(html: Column, page_url: Column) -> Column:
    """Absolute targets of all anchors, host-relative ones joined to the page's host."""
    site = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    hrefs = F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))
    absolute = F.transform(hrefs, lambda h: F.when(h.startswith("/"), F.concat(site, h)).otherwise(h))
    return F.filter(absolute, lambda h: h.startswith("https"))


def words_share_over(text: Column, limit: int) -> Column:
    """1.0 where the text is longer than `limit` words, for averaging."""
    return (word_count(text) > limit).cast("double")
