"""Small published cases."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.functions import arrays as ar
from textloom.functions import templates as tp
from textloom.functions import text as tx
from textloom.operators import labels as lb
from textloom.operators import metrics as mt
from textloom.operators import pooling, splits
from textloom.operators import statistics as st

CHAT = [
    ("user", "Which port is open?"),
    ("assistant", "Only the north port."),
    ("user", "Until when?"),
]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def chat(spark):
    return spark.createDataFrame([(1, CHAT)], "id int, m array<struct<role:string,content:string>>")


def test_first_seen_codes(spark):
    ports = ["north", "west", "west", "north", "quay", "west"]
    df = spark.createDataFrame(list(enumerate(ports)), "i bigint, a string")
    rows = splits.encode_first_seen(df, "a", "i", "code").orderBy("i").collect()
    assert [r.code for r in rows] == [0, 1, 1, 0, 2, 1]


def test_chat_in_inst_form(chat):
    old = chat.select(tp.inst_chat(F.col("m")).alias("x")).first().x
    assert old == (
        "<s>[INST] Which port is open? [/INST] Only the north port. </s>"
        "<s>[INST] Until when? [/INST]"
    )
    new = chat.select(tp.inst_chat(F.col("m"), spaced=False).alias("x")).first().x
    assert new == (
        "<s>[INST] Which port is open? [/INST]Only the north port.</s> "
        "[INST] Until when? [/INST]"
    )


def test_chatml_with_marks(chat):
    text = chat.select(tp.chatml(F.slice("m", 1, 1), bos="<bos>", eos="<eos>").alias("x")).first().x
    assert text == "<bos><|im_start|>user\nWhich port is open?<|im_end|>\n<eos>"
    assert chat.select(tp.chatml(F.slice("m", 1, 0), generate=True).alias("x")).first().x == "<|im_start|>assistant\n"


def spans(spark, rows):
    return spark.createDataFrame(rows, "doc_id int, class string, span_id int, start_word int, end_word int")


@pytest.mark.parametrize(
    "predicted, tp_fp_fn",
    [([(1, 3)], (1, 0, 0)), ([(1, 3), (1, 4)], (1, 1, 0)), ([(1, 2)], (0, 1, 1))],
)
def test_span_overlap(spark, predicted, tp_fp_fn):
    truth = spans(spark, [(1, "Ship", 0, 1, 5)])
    guess = spans(spark, [(1, "Ship", i, a, b) for i, (a, b) in enumerate(predicted)])
    row = mt.span_f1(truth, guess, "doc_id").first()
    assert (row.tp, row.fp, row.fn) == tp_fp_fn
    if len(predicted) == 2:
        best = mt.span_matches(truth, guess, "doc_id").orderBy(F.desc("overlap_gt")).first()
        assert best.pred_id == 1


def test_span_overlap_across_buckets(spark):
    truth = spans(spark, [(1, "Ship", 0, 60, 70), (1, "Ship", 1, 128, 300)])
    guess = spans(spark, [(1, "Ship", 0, 62, 72), (1, "Ship", 1, 120, 290)])
    pairs = mt.span_matches(truth, guess, "doc_id").collect()
    assert sorted((p.gt_id, p.pred_id, p.shared) for p in pairs) == [(0, 0, 9), (1, 1, 163)]


def test_compat_counts_missing_sides_once(spark):
    truth = spans(spark, [(1, "A", 0, 0, 4), (2, "A", 1, 0, 4)])
    guess = spans(spark, [(1, "A", 0, 0, 4), (3, "A", 1, 0, 4)])
    clean = mt.span_f1(truth, guess, "doc_id").first()
    compat = mt.span_f1(truth, guess, "doc_id", reference_compat=True).first()
    assert (clean.tp, clean.fp, clean.fn) == (1, 1, 1)
    assert (compat.tp, compat.fp, compat.fn) == (1, 2, 2)


def test_tag_runs(spark):
    tags = ["O"] + ["B-Harbour", "I-Harbour"] * 1 + ["B-Harbour"] + ["O"] * 2 + ["B-Ship"] + ["I-Ship"] * 4
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "doc_id int, word_no int, tag string")
    found = lb.tag_spans(df, "doc_id").orderBy("start_word").collect()
    assert [(s["class"], s.start_word, s.end_word) for s in found] == [
        ("Harbour", 1, 2), ("Harbour", 3, 3), ("Ship", 6, 10),
    ]


def test_entity_scores(spark):
    true = [["B-Ship", "I-Ship", "O", "O"], ["O", "B-Harbour", "O"], ["B-Ship", "O"]]
    pred = [["B-Ship", "O", "O", "O"], ["O", "B-Harbour", "O"], ["O", "O"]]
    frame = lambda tags: spark.createDataFrame(
        [(d, i, t) for d, row in enumerate(tags) for i, t in enumerate(row)], "doc_id int, word_no int, tag string"
    )
    got = mt.entity_scores(
        lb.tag_spans(frame(true), "doc_id"), lb.tag_spans(frame(pred), "doc_id"), ["doc_id", "class", "start_word", "end_word"]
    ).first()
    assert (got.tp, got.n_true, got.n_predicted, got.f1) == (1, 3, 2, 0.4)


def test_last_token(spark):
    lengths = [4, 3, 2, 5]
    rows = [(s, p, [float(5 * s + p + 1)], int(p < n)) for s, n in enumerate(lengths) for p in range(5)]
    df = spark.createDataFrame(rows, "s int, p int, v array<float>, m int")
    got = pooling.last_token(df, "s", "v", "p", F.col("m")).orderBy("s").collect()
    assert [r.pooled[0] for r in got] == [4, 8, 12, 20]


def test_padding_mask(spark):
    ids = F.array(*[F.lit(i) for i in (7, 8, 9)])
    assert one(spark, ar.mask(ids, 5)) == [1, 1, 1, 0, 0]
    assert one(spark, ar.padded(ids, 5, left=True)) == [0, 0, 7, 8, 9]


def test_chunk_mean(spark):
    rows = [(1, c, p + d) for c, p in enumerate([0.125, 0.25, 0.625]) for d in (-0.01, 0.01)]
    df = spark.createDataFrame([(d, c, float(p)) for d, c, p in rows], "doc_id int, class int, p double")
    got = st.chunk_class(df, "doc_id").first()
    assert got["class"] == 2 and round(got.p, 4) == 0.625


def test_json_island(spark):
    text = 'The list you wanted:\n{\n "ships": [{"name": "A {b}"}, {"name": "C"}]\n}\nEnd of list.'
    island = one(spark, tx.json_island(F.lit(text)))
    assert island.startswith("{") and island.endswith("}") and "ships" in island
    assert one(spark, tx.json_island(F.lit("none here"))) is None


def test_label_alignment(spark):
    ids = F.lit([-1, 0, 1, 1, 1, 2, -1])
    labels = F.lit([3, 4, 5])
    assert one(spark, lb.align_labels(ids, labels)) == [-100, 3, 4, -100, -100, 5, -100]
    assert one(spark, lb.align_labels(ids, labels, all_pieces=True)) == [-100, 3, 4, 4, 4, 5, -100]


def test_quiz_score(spark):
    df = spark.createDataFrame([(i < 11,) for i in range(21)], "ok boolean")
    share = df.agg(F.round(100 * F.avg(F.col("ok").cast("int")), 2)).first()[0]
    assert share == 52.38


def test_two_branch_prompt(spark):
    plain = one(spark, tp.two_branch(F.lit("I"), F.lit(" "), F.lit("O")))
    compat = one(spark, tp.two_branch(F.lit("I"), F.lit(" "), F.lit("O"), reference_compat=True))
    assert "### Input" not in plain and "### Input" in compat


def test_overlapping_windows_end_with_the_last_id(spark):
    ids = F.sequence(F.lit(0), F.lit(999))
    got = one(spark, ar.windows(ids, 510, 128))
    assert [w[0] for w in got] == [0, 382, 764] and got[-1][-1] == 999
    assert len(one(spark, ar.windows(F.sequence(F.lit(1), F.lit(510)), 510, 128))) == 1


def test_word_counts_differ_on_double_blanks(spark):
    assert one(spark, tx.word_count(F.lit("a  b c"))) == 3
    assert one(spark, F.size(tx.space_parts(F.lit("a  b")))) == 3


def test_marked_line_is_dropped(spark):
    text = "keep (this)\nTitle | Artist\n[Chorus] und–so"
    got = one(spark, tx.map_characters(F.lit(text), tx.LYRIC_LETTERS, tx.LYRIC_SPACES, tx.LYRIC_REMOVALS))
    assert got == "keep this\n\n undso"


def test_report_matches_counts(spark):
    pdf = pd.DataFrame({"y": [0, 0, 1, 2], "p": [0, 1, 1, 1]})
    rows = {r["class"]: r for r in mt.class_report(spark.createDataFrame(pdf), "y", "p").collect()}
    assert rows["1"].precision == pytest.approx(1 / 3) and rows["1"].recall == 1.0
    assert rows["2"].f1 == 0.0 and rows["accuracy"].f1 == 0.5
