"""Mixing where ids are missing: rows still spread, and the cut is still exact."""

import re

from pyspark.sql import functions as F

from strandline.llm import mixing


def test_rows_without_an_id_spread_over_buckets(spark, monkeypatch):
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.concat_ws(" ", F.lit("a"), F.col("id")).alias("text"))
    seen = docs.select(F.shiftrightunsigned(F.xxhash64(F.lit(1), "source", "doc_id", F.xxhash64("text")), 54).alias("b")).groupBy("b").count()
    assert seen.count() == 1024
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)  # so that the bits grow beyond the least
    for share in (0.3, 1.37):
        got = mixing.mixed(docs, share=share).agg(F.sum("taken"), F.max("taken"), F.count_if(F.col("taken") == 1), F.count_if(F.col("taken") == 3), F.first("target")).first()
        assert got[0] == round(got[4]) == round(share * 200_000) and got[1] <= 4 and got[2] + got[3] <= 1


def test_the_plan_sorts_and_moves_the_texts_of_the_bucket_of_the_cut_alone(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = mixing.take(docs)
    taken.explain()
    plan = capsys.readouterr().out
    assert len(re.findall(r"[-+] Window ", plan)) == 1 and len(re.findall(r"Filter .*NOT cut", plan)) == 1  # rows of other buckets go past the window
    by_source = mixing.mixed(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("n")).collect()
    words = taken.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in words} == {r["source"]: r["n"] for r in by_source}
