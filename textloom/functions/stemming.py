"""Porter's suffix stripping (Porter 1980) for one word at a time.

Called on a vocabulary, never on running text.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published suffix tables of steps 2, 3 and 4.
STEP2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous "
    "ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble"
)
STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"

_VOWEL_RUN = re.compile("v+c+")


def _shape(stem: str) -> str:
    """The stem as v/c letters; y counts as a vowel after a consonant."""
    out = []
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN.findall(_shape(stem)))


def _short_end(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _longest(word: str, table: str) -> tuple[str, str] | None:
    pairs = [(entry.partition(":")[0], entry.partition(":")[2]) for entry in table.split()]
    hits = [pair for pair in pairs if word.endswith(pair[0])]
    return max(hits, key=lambda pair: len(pair[0])) if hits else None


def _plural(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix):
            if "v" not in _shape(stem):
                return word
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c" and stem[-1] not in "lsz":
                return stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def stem_word(word: str) -> str:
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP2, STEP3):
        hit = _longest(word, table)
        if hit and _measure(word[: -len(hit[0])]) > 0:
            word = word[: -len(hit[0])] + hit[1]
    hit = _longest(word, STEP4)
    if hit:
        stem = word[: -len(hit[0])]
        if _measure(stem) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(T.StringType())
def porter_stem(words: pd.Series) -> pd.Series:
    return words.map(stem_word, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_words(lists: pd.Series) -> pd.Series:
    """Stems of the words of each row; a batch stems each of its words once."""
    known: dict[str, str] = {}

    def stem(word):
        if word is not None and word not in known:
            known[word] = stem_word(word)
        return known.get(word)

    return lists.map(lambda row: [stem(word) for word in row], na_action="ignore")
