"""A stored slot map is edited by later runs."""

from __future__ import annotations

from plumeline.llm.sharding import SlotMap, shard


def test_a_grown_corpus_moves_few_records(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(id % 40 as int)) as text")
    before = {r.doc_id: r.shard for r in shard(docs, shards=5, slots=512, map_path=path).collect()}
    stored = SlotMap.load(spark, path, 2)
    assert (stored.version, stored.shards) == (2, 5)

    more = docs.union(spark.range(3000, 3300).selectExpr("id as doc_id", "'new' as text"))
    rows = shard(more, shards=5, slots=512, slot_map=stored, map_path=path).collect()
    assert sum(before[r.doc_id] != r.shard for r in rows if r.doc_id in before) < 0.1 * 3000
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(5)]
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes)
    for s in range(5):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert SlotMap.load(spark, path, 3).version == 3
    assert SlotMap.load(spark, path, 2) == stored  # the earlier version stays readable


def test_one_more_shard_takes_from_all(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(id % 40 as int)) as text")
    before = {r.doc_id: r.shard for r in shard(docs, shards=4, slots=512, map_path=path).collect()}
    rows = shard(docs, shards=5, slots=512, slot_map=SlotMap.load(spark, path, 2), map_path=path).collect()
    moved = sum(before[r.doc_id] != r.shard for r in rows)
    assert {r.shard for r in rows} == set(range(5)) and moved < 0.3 * 3000
