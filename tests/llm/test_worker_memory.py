"""Few Python workers an executor, and none that keeps the memory of a task that has ended."""

import re
import weakref

import pyarrow as pa

from tests.llm import brute
from textloom.llm import common, mixing, packing, simhash
from textloom.llm.queries import tokenizer_path


class _Frame:
    """Stands for a table: keeps the function that tasks would run."""

    def __init__(self, spark):
        self.sparkSession = spark

    def mapInArrow(self, run, schema):
        self.run = run


class _Column(list):
    pass


def test_a_task_gives_its_memory_back_when_nothing_holds_it_any_more(spark, monkeypatch):
    made, living = [], []

    def doubled(batches):
        for batch in batches:
            column = _Column(2 * v for v in common.values(batch, "n"))
            made.append(weakref.ref(column))
            yield {"n": column}
            del column

    monkeypatch.setattr(common, "release_memory", lambda: living.append([r() for r in made]))
    frame = _Frame(spark)
    common.map_batches(frame, doubled, "n long")
    out = frame.run(iter([pa.RecordBatch.from_pydict({"n": [k, k + 1]}) for k in (0, 5)]))
    assert [b.to_pydict()["n"] for b in out] == [[0, 2], [10, 12]]
    assert living == [[None, None]]
    assert list(frame.run(iter([]))) == []
    assert len(living) == 2


def test_release_memory_leaves_what_is_in_use():
    kept = pa.array(["a" * 1000] * 1000)
    common.release_memory()
    assert kept.to_pylist() == ["a" * 1000] * 1000


def test_sets_of_groups_need_one_worker_a_task(spark, monkeypatch):
    plans, whole = {}, simhash.Stored

    def stored(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, name)

    monkeypatch.setattr(simhash, "Stored", stored)
    rows = spark.createDataFrame([(k, " ".join(f"w{k + i}" for i in range(20))) for k in range(6)], "uid long, text string")
    rooted = spark.createDataFrame([(k, bytes(8), k) for k in range(6)], "node long, fp binary, root long")
    groups = spark.createDataFrame([(k, 0) for k in range(6)], "node long, root long")
    found = simhash._alike_in_groups(rows, rooted, groups, 1, 0.8, 8, 64).collect()
    assert brute.components([(r.a, r.b) for r in found]) == brute.components([(k, k + 1) for k in range(5)])
    assert len(re.findall("MapInArrow", plans["sets"])) == 1


def test_budgets_of_a_mix_come_without_workers(spark):
    rows = [(k, None if k % 4 == 0 else f"s{k % 4}", "w " * k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    stored = common.Stored(docs, "mix").df
    mixed = mixing.mix(stored, common.word_count(stored.text))
    assert "ExistingRDD" not in mixed._jdf.queryExecution().executedPlan().toString()
    assert {r.source for r in mixed.collect()} == {None, "s1", "s2", "s3"}
    assert mixing.mix(stored.limit(0), common.word_count(stored.text)).collect() == []


def test_few_words_in_memory_give_the_same_pieces(spark):
    texts = [" ".join(f"word{k * i % 97}x{i}" for i in range(k % 50)) for k in range(200)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    few = packing.pieces(docs, tokenizer_path(), 64, most_known=50).select(*columns).collect()
    assert sorted(few) == sorted(packing.pieces(docs, tokenizer_path(), 64).select(*columns).collect())
