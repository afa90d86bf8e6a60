"""Clusters of many short texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.llm import minhash


def test_many_short_texts_are_many_blocks(spark):
    members = spark.range(20_000).select(F.lit(7).cast("long").alias("component"), F.lit(3).cast("long").alias("n_shingles"))
    long = spark.range(10).select(F.lit(8).cast("long").alias("component"), F.lit(50_000).cast("long").alias("n_shingles"))
    assert {r.component: r.blocks for r in minhash.block_counts(members.union(long)).collect()} == {7: 14, 8: 5}


def test_blocks_of_short_texts_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCUMENTS", 7)
    rows = [(i, f"page not found error {i}") for i in range(60)] + [(100 + i, f"page not found error {i} x") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=3, percent=50, halves=20, rows=2).collect()}
    assert found == {i: 0 for i, _ in rows}
