"""Secrets by keyword, anchored pattern and checksum.

One Aho-Corasick pass finds the keywords of all kinds; a pattern is tried only
where a keyword stands, anchored there. Runs of hexadecimal digits have no
keyword: any run of 16 covers a place divisible by 16, and only the places
there that hold a digit are grown to both sides. Token kinds that embed a
checksum count only if it is right.

Spans are code points, end exclusive. A null text counts as empty. Texts are
scanned whole, one at a time; repeated rows are scanned alike.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import map_batches, utf8, values

BASE = ("assign", "access", "hex")
# Prefixes of public token formats. The first two kinds end in a CRC-32 of what stands before.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "private_key": ("-----begin ",),
    "slack": ("xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"),
    "payment": ("sk_live_", "rk_live_"),
}
KINDS = (*BASE, *[k for k in KEYWORDS if k not in BASE])
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
PATTERNS = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "private_key": re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    "slack": re.compile(r"xox[bpars]-[A-Za-z0-9-]{10,}"),
    "payment": re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}"),
}
LEAST_HEX = 16
_HEX = frozenset("0123456789abcdef")
_NOT_HEX = re.compile(r"[^0-9a-f]")
_STATE: dict = {}


def crc32_suffix(token: str) -> bool:
    """Whether the last six characters are the base-62 CRC-32 of the body after the prefix."""
    body, stated = token[4:-6], token[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == stated


def jwt_header(token: str) -> bool:
    """Whether the first part decodes to an object that names its algorithm."""
    head = token.split(".", 1)[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError):
        return False
    return isinstance(found, dict) and "alg" in found


VALID = {"github": crc32_suffix, "npm": crc32_suffix, "jwt": jwt_header}


def _automaton():
    if "keywords" not in _STATE:
        import ahocorasick

        found = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                found.add_word(word, (kind, len(word)))
        found.make_automaton()
        _STATE["keywords"] = found
    return _STATE["keywords"]


_NOT_TOKEN = re.compile(r"[^A-Za-z0-9_-]")


def ascii_lower(text: str) -> str:
    """A-Z alone in lower case, so that every code point keeps its place."""
    return text.encode().lower().decode()


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Maximal runs of `[0-9a-f]` of 16 or more."""
    runs, end = [], 0
    for i, char in enumerate(text[LEAST_HEX - 1 :: LEAST_HEX]):
        if char in _HEX:
            at = (i + 1) * LEAST_HEX - 1
            if at < end:
                continue
            stop = _NOT_HEX.search(text, at)
            end = stop.start() if stop else len(text)
            start = at
            while start and text[start - 1] in _HEX:
                start -= 1
            if end - start >= LEAST_HEX:
                runs.append((start, end))
    return runs


def scan(text: str) -> list[tuple[int, int, int]]:
    """`(start, kind, end)` of every secret, by start and then kind; spans of a kind do not overlap."""
    low = ascii_lower(text)
    spans = [(start, BASE.index("hex"), end) for start, end in hex_runs(text)]
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, n) in _automaton().iter(low):
        start = last + 1 - n
        if start < done[kind]:
            continue
        match = PATTERNS[kind].match(low if kind == "assign" else text, start)
        if not match:
            if kind == "jwt" and text.startswith("eyJ", start):
                # What the header lacks comes after its run of letters, so no later start in the run can match.
                stop = _NOT_TOKEN.search(text, start)
                done[kind] = stop.start() if stop else len(text)
            continue
        done[kind] = match.end()
        if kind == "assign" and len(match[1]) < 12 or kind == "access" and len(match[0]) < 18:
            continue
        if kind in VALID and not VALID[kind](match[0]):
            continue
        spans.append((start, KINDS.index(kind), match.end()))
    return sorted(spans)


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """`(doc_id, n_assign, n_access, n_hex, base_sha256, spans)` of `docs(doc_id, text)`, row by row."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _report, schema)


def _report(batches):
    for batch in batches:
        out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        out["doc_id"] = values(batch, "doc_id")
        for text in utf8(batch, "text"):
            spans = scan((text or b"").decode())
            for k, name in enumerate(BASE):
                out[f"n_{name}"].append(sum(kind == k for _, kind, _ in spans))
            base = digest([s for s in spans if s[1] < len(BASE)])
            out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            out["spans"].append(digest(spans))
        yield out


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret of `text` replaced by `mask`; overlapping spans become one. Null stays null."""

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: t if t is None else mask_spans(t, scan(t), mask))

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mask_spans(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text
