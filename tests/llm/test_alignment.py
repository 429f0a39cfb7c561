"""The alignment of two tokenizers against a plain version, on a given table and on odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from textloom.llm import alignment
from textloom.llm.queries import QUERIES, piece_model_path, tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (None, "a null id"), (1, None), (2, ""), (3, " "), (4, "one"), (4, "one"), (4, "other text, same id"), (5, "a  b\n\nc\td 　e\x00"),
    (6, "▁takes a space"), (7, "x<|endoftext|> <s> <0x41> </s>"), (8, "中文 émoji 🙂🙂 ﬁ"), (9, "  leading and trailing  "),
    (10, "The and of " * 40_000), (11, "ab" * 200_000), (12, "\r\n" * 30 + "'S 's 12345"),
]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    return lambda rows: Counter(brute.alignment(rows, tokenizer, model))


@pytest.mark.parametrize("rows", [[], ODD[1:3], ODD], ids=["empty", "no tokens", "odd"])
def test_odd_rows(spark, plain, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("block", "pairs", "links", "n_a", "count", "best"):
        df = df.withColumn(name, F.lit("clash"))
    got = alignment.align(df, tokenizer_path(), piece_model_path(), links_per_block=20).select(*COLUMNS)
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_documents(spark, tables, plain):
    rows = [(r.doc_id, r.text) for r in tables.documents.select("doc_id", "text").collect()]
    got = QUERIES["op12_alignment"](spark, SF)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_the_table_of_ranks_gives_the_ids_of_the_file():
    from tokenizers import Tokenizer

    plain, ours = Tokenizer.from_file(tokenizer_path()), alignment.ByteTokens(tokenizer_path())
    plain.encode_special_tokens = True
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0x200B, 0x1680, 0x1F600, 0x4E2D, 0x661, 0xB2, 0xFEFF]]
    letters += ["'s", "'ll", " ", "  ", "\n", "'S", "<|endoftext|>"] * 20
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
        assert ours.ids(" " + text) == plain.encode(" " + text, add_special_tokens=False).ids
    for text in (" " * 50_000 + "a", "ab" * 50_000, " \n" * 50_000):
        assert ours.ids(" " + text) == plain.encode(" " + text, add_special_tokens=False).ids


def test_overlaps_and_groups_of_intervals():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a_ends = np.array(sorted({*rng.integers(1, 40, 8).tolist(), 40}))
        b_ends = np.array(sorted({*rng.integers(1, 40, 8).tolist(), 40}))
        a_starts, b_starts = np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]
        found = {(int(i), int(j)) for i, j in zip(*alignment.overlaps(a_starts, a_ends, b_starts, b_ends))}
        assert found == {
            (i, j) for i in range(len(a_ends)) for j in range(len(b_ends)) if a_starts[i] < b_ends[j] and b_starts[j] < a_ends[i]
        }
        group = alignment.coalesce(np.r_[a_starts, b_starts], np.r_[a_ends, b_ends])
        cuts = sorted(set(a_ends) & set(b_ends))
        assert group.tolist() == [sum(c < e for c in cuts) for e in (*a_ends, *b_ends)]
