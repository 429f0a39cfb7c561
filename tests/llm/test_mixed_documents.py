"""The documents of a mix keep the columns they came with."""

from pyspark.sql import functions as F

from textloom.llm import mixing


def test_columns_named_like_those_of_the_mix_stay_as_they_are(spark):
    rows = [(i, f"s{i % 3}", " ".join(["w"] * (i % 7))) for i in range(60)] + [(99, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, source string, text string")
    clash = plain.withColumn("size", F.lit(-1)).withColumn("taken", F.lit("mine")).withColumn("target", F.lit(0.5)).withColumn("source_size", F.lit(7))
    got = mixing.mixed_documents(clash)
    assert got.columns == clash.columns
    kept = got.collect()
    assert {(r.size, r.taken, r.target, r.source_size) for r in kept} == {(-1, "mine", 0.5, 7)}
    assert sorted((r.doc_id, r.text) for r in kept) == sorted((r.doc_id, r.text) for r in mixing.mixed_documents(plain).collect())
