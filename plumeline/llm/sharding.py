"""Byte-balanced shards over fixed virtual slots.

A record's hash gives its slot, one of ``SLOTS``; nothing about the record changes that.
Bytes are aggregated per slot, and a versioned map says which shard holds a slot.
Version 1 deals slots in turn; rebalancing edits it, moving as few slots as it can until
shards are near equal.  A slot heavier than ``1 / SPLIT`` of a shard is split into parts
by row, so one repeated record, or id, can fill several shards.  The map is as large as
``SLOTS`` plus at most ``2 * SPLIT`` parts per shard, whatever the corpus, and is all that reaches the driver.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch

SLOTS = 8192
SPLIT = 8
ROW_OVERHEAD = 16
#: Largest spread between shards, as a share of a shard, that is not worth a move.
TOLERANCE = 0.0005
STORED = "vslot int, part int, shard int"


@dataclass(frozen=True)
class SlotMap:
    """Shard of every ``(slot, part)``; editing gives the next version."""

    version: int
    shards: int
    shard_of: dict[tuple[int, int], int]

    @classmethod
    def first(cls, keys: list[tuple[int, int]], shards: int) -> SlotMap:
        return cls(1, shards, {key: i % shards for i, key in enumerate(sorted(keys))})

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> SlotMap:
        """A stored version; its rows, at most slots and their parts, pass the driver."""
        rows = spark.read.schema(STORED).parquet(f"{path}/version={version}").collect()
        return cls(version, max((r["shard"] for r in rows), default=-1) + 1, {(r["vslot"], r["part"]): r["shard"] for r in rows})

    def rebalanced(self, weight: dict[tuple[int, int], int], shards: int | None = None) -> SlotMap:
        """The next version, for ``shards`` (default: as many as now): slots move from
        the heaviest to the lightest shard while that brings the two closer.  Slots and
        parts that the map does not know yet go to the lightest shards."""
        shards = shards or self.shards
        held: list[list[tuple[int, tuple[int, int]]]] = [[] for _ in range(shards)]
        moved = dict(self.shard_of)
        homeless = []
        for key, shard in moved.items():
            if shard < shards:
                held[shard].append((weight.get(key, 0), key))
            else:
                homeless.append((weight.get(key, 0), key))
        homeless += [(w, key) for key, w in weight.items() if key not in moved]
        for slots in held:
            slots.sort()
        total = [sum(w for w, _ in slots) for slots in held]
        for w, key in sorted(homeless, reverse=True):
            light = min(range(shards), key=total.__getitem__)
            insort(held[light], (w, key))
            total[light] += w
            moved[key] = light
        enough = max(1.0, TOLERANCE * sum(total) / shards)
        heavy = [(-t, s) for s, t in enumerate(total)]
        heapq.heapify(heavy)
        while heavy:
            top, source = heapq.heappop(heavy)
            if -top != total[source]:
                continue
            light = min(range(shards), key=total.__getitem__)
            gap = total[source] - total[light]
            if gap <= enough:
                break
            slots = held[source]
            at = bisect_left(slots, (gap / 2,))
            near = [i for i in (at - 1, at) if 0 <= i < len(slots) and 0 < slots[i][0] < gap]
            if not near:
                continue  # nothing movable here: the next heaviest
            w, key = slots.pop(min(near, key=lambda i: abs(gap / 2 - slots[i][0])))
            insort(held[light], (w, key))
            total[source] -= w
            total[light] += w
            moved[key] = light
            heapq.heappush(heavy, (-total[source], source))
            heapq.heappush(heavy, (-total[light], light))
        return replace(self, version=self.version + 1, shards=shards, shard_of=moved)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(slot, part, shard) for (slot, part), shard in self.shard_of.items()]
        return spark.createDataFrame(rows, STORED).coalesce(1)

    def store(self, spark: SparkSession, path: str) -> DataFrame:
        """Write this version beside the earlier ones and return it as a table."""
        self.to_frame(spark).write.parquet(f"{path}/version={self.version}")
        return spark.read.schema(STORED).parquet(f"{path}/version={self.version}")


def shard(
    docs: DataFrame, shards: int = 40, slots: int = SLOTS, slot_map: SlotMap | None = None, map_path: str | None = None
) -> DataFrame:
    """Shard and place of every document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard, virtual_slot``.

    ``size`` is the text's UTF-8 bytes plus ``ROW_OVERHEAD`` (null text: none), ``slot`` the
    row's place in its shard, gapless from 0.  ``docs`` needs ``doc_id, text``; other columns are
    ignored.  Null ids and repeated rows are spread like any heavy slot; no
    rows give no rows.

    ``slot_map`` is the map of an earlier run with the same ``slots``: it is edited, not built anew, so records
    move only as far as balance asks for, and the edit is the next version.  Versions are written below ``map_path``, a
    folder shared by all executors (default: the run's own).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = scratch.save(rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int")))
    by_slot = {r["vslot"]: r["bytes"] for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()}
    limit = max(1, sum(by_slot.values()) // (shards * SPLIT))
    parts = {slot: -(-b // limit) for slot, b in by_slot.items() if b > limit}
    split = spark.createDataFrame(list(parts.items()), "vslot int, parts long").coalesce(1)
    part = F.pmod(F.xxhash64("_row"), F.coalesce("parts", F.lit(1))).cast("int")
    placed = rows.join(F.broadcast(split), "vslot", "left").select(*rows.columns, part.alias("part"))
    weighed = placed.groupBy("vslot", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    weight = {(r["vslot"], r["part"]): r["bytes"] for r in weighed}
    map_path = map_path or f"{scratch.root}/map"
    if slot_map is None:
        slot_map = SlotMap.first(list(weight), shards)
        slot_map.store(spark, map_path)
    balanced = slot_map.rebalanced(weight, shards)
    balanced.store(spark, map_path)

    start, at = [0] * shards, []
    for r in sorted(weighed, key=lambda r: (r["vslot"], r["part"])):
        home = balanced.shard_of[(r["vslot"], r["part"])]
        at.append((r["vslot"], r["part"], home, start[home]))
        start[home] += r["n"]
    places = spark.createDataFrame(at, "vslot int, part int, shard int, first long").coalesce(1)
    inside = W.partitionBy("vslot", "part").orderBy("doc_id", "text_crc32", "_row")
    numbered = placed.withColumn("nth", F.row_number().over(inside))
    return numbered.join(F.broadcast(places), ["vslot", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
    )
