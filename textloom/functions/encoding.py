"""Repair of text that was decoded with the wrong code page."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters and marks that have no base letter of their own.
ASCII_FORMS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "ð": "d", "þ": "th",
    "ł": "l", "Ł": "L", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "€": "EUR",
    "«": "<<", "»": ">>", "¿": "?", "¡": "!", "\xa0": " ",
}


# What cp1252 shows for the bytes 0x80 to 0x9F, and the code points of those bytes.
_SHOWN = {bytes([b]).decode("cp1252", "ignore"): chr(b) for b in range(0x80, 0xA0)}
_SHOWN.pop("", None)


def repaired(text: Column) -> Column:
    """UTF-8 text that was read as cp1252 or latin-1, put right; any other text as it is.

    Each character is taken as one byte. The bytes are the text only if all
    characters have one and the bytes are valid UTF-8, so text that was never
    damaged (typographic quotes, dashes, the euro sign) is not touched.
    """
    single = F.translate(text, "".join(_SHOWN), "".join(_SHOWN.values()))
    raw = F.when(single.rlike(r"\A[\x00-\xFF]*\z"), F.encode(single, "ISO-8859-1")).cast("string")
    return F.coalesce(F.when(F.is_valid_utf8(raw), raw), text)


_FORMS = str.maketrans(ASCII_FORMS)


def to_ascii(text: str) -> str:
    if text.isascii():
        return text
    return unicodedata.normalize("NFKD", text.translate(_FORMS)).encode("ascii", "ignore").decode("ascii")


TEXTS_AT_ONCE = 200


@F.arrow_udf(T.StringType())
def _ascii_forms(texts: pa.Array) -> pa.Array:
    """Texts outside ASCII are Python strings a few at a time; the others stay as they are."""
    other = pc.fill_null(pc.invert(pc.string_is_ascii(texts)), False)
    changed = texts.filter(other)
    parts = []
    for at in range(0, len(changed), TEXTS_AT_ONCE):
        parts.append(pa.array(map(to_ascii, changed.slice(at, TEXTS_AT_ONCE).to_pylist()), texts.type))
    return pc.replace_with_mask(texts, other, pa.concat_arrays(parts)) if parts else texts


def repair_encoding(text: Column | str) -> Column:
    return _ascii_forms(repaired(F.col(text) if isinstance(text, str) else text))
