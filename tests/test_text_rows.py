"""Words, pieces and spans of a text meet in one row: only texts are shuffled, ids may repeat or be null."""

import itertools
import random
from collections import Counter

import pytest

from __spark_entry__ import queries
from textloom.operators.joins import places_inside
from textloom.plans.fixtures import CLASSES

rng = random.Random(3)
TEXTS = {1: ["one"], 2: [""], 3: [" ".join("abcdefghijklm"[: rng.randint(1, 13)] for _ in range(61))], 4: ["x é 漢字漢字漢 " * 9] * 2, 5: ["a b c", "d e f g h i j k l m n o p q"], None: ["null keys stay apart"]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts"))
    rows = [(key, text) for key, texts in TEXTS.items() for text in texts] + [(6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def _words(texts):
    """`(word_no, word, start, end)` in the text of all words in the order of their numbers."""
    at, out = 0, []
    for i, w in sorted((i, w) for text in texts for i, w in enumerate(text.split())):
        out.append((i, w, at, at + len(w)))
        at += len(w) + 1
    return out


def _pieces(words):
    return [(no, w[o : o + 4], start + o, min(start + o + 4, end)) for no, w, start, end in words for o in range(0, len(w), 4)]


def _spans(key, texts):
    words, out = _words(texts), []
    for text in texts if key is not None else ():
        n = len(text.split())
        for k in range((n + 11) // 12):
            first, last = 12 * k, min(12 * k + 7, n - 1)
            ends = itertools.product((w[2] for w in words if w[0] == first), (w[3] for w in words if w[0] == last))
            out += [(k, (key + k) % 7, a, b) for a, b in ends]
    return out


def test_word_of_each_piece(spark, folder):
    got = Counter((r.doc_id, r.tok_start, r.token, r.word_no) for r in queries()["k8_token_word_map"](spark, folder).collect())
    want = Counter((key, start, token, -1 if key is None else no) for key, texts in TEXTS.items() for no, token, start, _ in _pieces(_words(texts)))
    assert got == want


def test_words_in_spans(spark, folder):
    got = Counter((r.doc_id, r.word_no, r.k, r["class"]) for r in queries()["j6_tokens_in_spans"](spark, folder).collect())
    want = Counter(
        (key, no, k, CLASSES[c]) for key, texts in TEXTS.items() for no, _, s, e in _words(texts) for k, c, a, b in _spans(key, texts) if a <= s and e <= b
    )
    assert got == want


def test_targets_of_pieces(spark, folder):
    got = Counter((r.doc_id, r.tok_start, r.target) for r in queries()["k11_span_targets"](spark, folder).collect())
    want = Counter()
    for key, texts in TEXTS.items():
        pieces, spans = _pieces(_words(texts)), _spans(key, texts)
        for _, _, s, e in pieces:
            held = [(a, 2 * c + (s != min(x[2] for x in pieces if any(a == y[2] <= x[2] and x[3] <= y[3] for y in spans)))) for _, c, a, b in spans if a <= s and e <= b]
            want[(key, s, max(held)[1] if held else 14)] += 1
    assert got == want


@pytest.mark.parametrize("name", ["k8_token_word_map", "k11_span_targets", "j6_tokens_in_spans"])
def test_only_texts_and_spans_are_shuffled(spark, folder, name, monkeypatch):
    monkeypatch.setattr("textloom.plans.fixtures.text_parts", lambda t: 4)
    # Nothing joined by broadcast, so that every shuffle is seen.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.split("\n") if "Exchange" in line]
    assert 1 <= len(shuffles) <= 2 and all("hashpartitioning(doc_id" in x and "REPARTITION_BY_NUM" in x for x in shuffles)
    assert all(x.count("#") == 1 for x in shuffles)  # the text's id alone: no place, no bucket


def test_pairs_equal_plain_ones():
    import numpy as np

    r = np.random.default_rng(1)
    for low, size, width in ((0, 40, 300), (-500, 1000, 3), (0, 1 << 40, 1 << 38)):
        p_text, s_text = np.sort(r.integers(0, 3, 80)), np.sort(r.integers(0, 3, 50))
        p_start, s_start = r.integers(low, low + size, 80), r.integers(low, low + size, 50)
        p_end, s_end = p_start + r.integers(0, 5, 80), s_start + r.integers(0, width, 50)
        bucket = max(16, size // 64)
        got = sorted(zip(*map(list, places_inside(p_text, p_start, p_end, s_text, s_start, s_end, bucket)), strict=True))
        want = [(i, j) for i in range(80) for j in range(50) if p_text[i] == s_text[j] and s_start[j] <= p_start[i] and p_end[i] <= s_end[j]]
        assert got == want and want


def test_texts_of_a_batch_are_taken_a_few_at_a_time(monkeypatch):
    import pyarrow as pa

    from textloom.operators import joins

    texts = [[*range(n)] for n in (0, 3, 50, 0, 7, 1, 20)]
    lists, nothing = pa.array(texts, pa.list_(pa.int64())), pa.array([[]] * 7, pa.list_(pa.int64()))
    whole = joins.pairs_inside((lists, lists), (lists, lists), 16)
    seen, real = [], joins.places_inside
    monkeypatch.setattr(joins, "places_inside", lambda *a: seen.append(len(a[0])) or real(*a))
    monkeypatch.setattr(joins, "ROWS_AT_ONCE", 20)
    few = joins.pairs_inside((lists, lists), (lists, lists), 16)
    assert [x.tolist() for x in few] == [x.tolist() for x in whole] and sorted(whole[0]) == [*range(81)] and whole[0].tolist() == whole[1].tolist()
    assert max(seen) == 50 and sum(seen) == 81 and len(seen) >= 4
    assert len(joins.pairs_inside((lists, lists), (nothing, nothing), 16)[0]) == 0
    assert len(joins.pairs_inside((lists[:0], lists[:0]), (nothing[:0], nothing[:0]), 16)[0]) == 0
