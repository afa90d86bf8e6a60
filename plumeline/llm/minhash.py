"""Near-duplicate documents by MinHash with tensored banding.

A table key of the usual banding needs fresh minhashes for every table.  Here
``halves`` left and ``halves`` right keys are formed from ``rows`` minhashes each, and every pair of
a left and a right key is a table: ``halves ** 2`` tables cost ``2 * halves * rows``
minhashes instead of ``2 * rows * halves ** 2``.  Two sets of similarity ``s`` share a
table with probability ``(1 - (1 - s ** rows) ** halves) ** 2``.

Steps: (1) one pass over the texts gives size, fingerprint and half keys of every shingle
set; equal sets become one; (2) the least member of each table bucket is tied to the others, and
connected components of these ties are the candidate clusters; (3) shingle sets of
clustered documents are built again from the texts and compared in full, all
with all within a cluster, in blocks of bounded size; (4) connected components of the confirmed links
are the answer.  No pair is formed outside the numpy comparison of two blocks, which
returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch, components

MAX_CACHED_WORDS = 300_000
# A block of a cluster holds about so many shingles; a task compares two blocks.
BLOCK_SHINGLES = 100_000
#: and at most about so many documents, as the comparison holds a count for every pair of them.
BLOCK_DOCUMENTS = 1_500
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, size: int, table: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; fewer words than ``size``
    are one shingle, no word gives none.  Only A-Z are lower-cased."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(table.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(size, len(hashes))
    shingles = np.full(len(hashes) - width + 1, len(hashes) if len(hashes) < size else size, dtype=np.uint64)
    for k in range(width):
        shingles = _mixed(shingles * np.uint64(31) + hashes[k : len(hashes) - width + 1 + k])
    return np.unique(shingles)


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_229)
    draw = lambda: random.integers(0, 1 << 63, size=count, dtype=np.uint64)
    return draw() * np.uint64(2) + np.uint64(1), draw()


def half_keys(shingles: np.ndarray, halves: int, rows: int, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``2 * halves`` keys, left ones first."""
    times, plus = seeds
    least = np.full(len(times), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        values = shingles[at : at + 512, None] * times
        values += plus
        np.minimum(least, values.min(axis=0), out=least)
    keys = np.arange(2 * halves, dtype=np.uint64)
    for column in least.reshape(2 * halves, rows).T:
        keys = _mixed(keys * np.uint64(31) + column)
    return keys


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _signatures(size: int, halves: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seeds = _WordHashes(), _seeds(2 * halves * rows)
        for batch in batches:
            out: list[tuple] = []
            for text in batch["text"].cast(pa.binary()):
                shingles = shingle_set(text.as_py(), size, table)
                h1 = xxhash.xxh3_64_intdigest(shingles.tobytes(), 1) if len(shingles) else 0
                h2 = xxhash.xxh3_64_intdigest(shingles.tobytes(), 2) if len(shingles) else 0
                keys = _signed(half_keys(shingles, halves, rows, seeds)) if len(shingles) else None
                out.append((len(shingles), h1, h2, keys))
            counts, h1, h2, keys = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(counts, pa.int64()),
                    pa.array(_signed(np.array(h1, dtype=np.uint64))),
                    pa.array(_signed(np.array(h2, dtype=np.uint64))),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "keys"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = _WordHashes(), set()
        for batch in batches:
            sets = [shingle_set(text.as_py(), size, table) for text in batch["text"].cast(pa.binary())]
            same = []
            for s, node, h in zip(sets, batch["node"].to_pylist(), batch["h1"].to_pylist()):
                same.append((node, h) not in seen and xxhash.xxh3_64_intdigest(s.tobytes(), 1) == h % (1 << 64))
                seen.add((node, h))
            kept = batch.select(["cluster", "node", "blocks", "h1"]).filter(pa.array(same, pa.bool_()))
            shingles = pa.array([_signed(s) for s, ok in zip(sets, same) if ok], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, shingles], names=["cluster", "node", "blocks", "h1", "shingles"])

    return run


def link_forest(sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links ``100 * common >= percent * union`` between ``sets``.
    Pairs of two sets on the same side are skipped where ``left`` tells two blocks apart."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        common = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2)
    else:
        owner = np.repeat(np.arange(n), sizes)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        owner, column = owner[shared], column[shared]
        _, column = np.unique(column, return_inverse=True)
        common = np.zeros((n, n), dtype=np.float32)
        width = 4096
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [start, start + width])
            dense = np.zeros((n, width), dtype=np.float32)
            dense[owner[a:b], column[a:b] - start] = 1
            common += dense @ dense.T
        common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = np.triu(100 * common >= percent * union, 1)
    if left.any() and not left.all():
        linked &= left[:, None] != left[None, :]
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = find(int(i)), find(int(j))
        if a != b:
            parent[b] = a
            forest.append((int(i), int(j)))
    return forest


def _compare(percent: int):
    """Rows arrive sorted by (cluster, first, second), so a task's groups follow each other."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        rows = list({(block, node, h1): (node, shingles, block == first) for node, block, first, h1, shingles in rows}.values())
        nodes, sets, left = zip(*rows)
        return [(nodes[i], nodes[j]) for i, j in link_forest(list(sets), np.array(left), percent)] if len(rows) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, found = None, [], []
        for batch in batches:
            shingles = batch["shingles"]
            flat, bounds = shingles.values.to_numpy(), shingles.offsets.to_numpy()
            columns = [batch[c].to_pylist() for c in ("cluster", "first", "second", "node", "block", "h1")]
            for k, (cluster, first, second, node, block, h1) in enumerate(zip(*columns)):
                if (cluster, first, second) != group:
                    if rows:
                        found += links(rows)
                    group, rows = (cluster, first, second), []
                rows.append((node, block, first, h1, flat[bounds[k] : bounds[k + 1]].copy()))
            if len(found) > 10_000:
                yield pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in found])
                found = []
        if rows:
            found += links(rows)
        if found:
            yield pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in found])

    return run


def block_counts(members: DataFrame) -> DataFrame:
    """``component, blocks`` of ``members (component, n_shingles)``: blocks bounded by shingles and by documents."""
    return members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_DOCUMENTS))
        ).cast("long").alias("blocks")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, halves: int = 12, rows: int = 3
) -> DataFrame:
    """Component of every document: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` (whole number) and ``text``; other columns are ignored.  Two documents are
    linked when ``100 * common >= percent * union`` of their sets of word shingles.
    ``component_id`` is the smallest ``doc_id`` reachable over links, ``kept`` tells whether it
    is the row's own.  Null, empty and blank texts have no shingle and are linked with
    nothing.  Rows that share a ``doc_id`` are judged each by its text, and texts whose smallest id is
    the same are one node of the graph; a null ``doc_id`` names nothing: such rows keep a null
    component and are kept.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    signed = scratch.save(
        named.mapInArrow(
            _signatures(shingle, halves, rows), "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, keys array<long>"
        )
    )
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    # Equal sets: one node, named by the smallest id.  Half keys of equal sets are equal.
    nodes = scratch.save(
        filled.groupBy("h1", "h2").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("least"), F.max("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")
        )
        .withColumn("node", F.col("least.doc_id"))
    )
    tables = F.expr(
        f"flatten(transform(slice(keys, 1, {halves}), (l, i) -> "
        f"transform(slice(keys, {halves + 1}, {halves}), (r, j) -> xxhash64(i, j, l, r))))"
    )
    # A row becomes halves ** 2 keys, so rows are dealt anew before.
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.select("node", "keys").repartition(width, "node").select("node", F.explode(tables).alias("key"))
    least = keyed.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("top")).where("u <> top")
    ties = keyed.join(least.select("key", "u"), "key").where("u <> node").select("u", F.col("node").alias("v")).distinct()
    clusters = scratch.save(components(ties, scratch))

    # Members with their cluster's number of blocks, then their sets from the texts.
    members = nodes.select("node", F.col("least.text_hash").alias("text_hash"), "n_shingles", "h1").join(clusters, "node")
    blocks = block_counts(members)
    members = members.join(blocks, "component").select(
        F.col("node").alias("doc_id"), "text_hash", F.col("component").alias("cluster"), "node", "blocks", "h1"
    )
    sets = (
        named.join(members, ["doc_id", "text_hash"])
        .select("text", "cluster", "node", "blocks", "h1")
        .mapInArrow(_sets(shingle), "cluster long, node long, blocks long, h1 long, shingles array<long>")
    )
    own = F.pmod(F.xxhash64("node", "h1"), F.col("blocks"))
    dealt = (
        sets.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "cluster", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
            "block", "node", "h1", "shingles",
        )
        .repartition("cluster", "first", "second")
        .sortWithinPartitions("cluster", "first", "second")
    )
    links = scratch.save(dealt.mapInArrow(_compare(percent), "u long, v long"))
    found = scratch.save(components(links, scratch))

    # Back to the documents: over their sets, then over shared ids.
    joined = signed.join(
        nodes.join(found, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component")),
        ["h1", "h2"],
        "left",
    )
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, that stay when one of each group of near
    copies is kept, the one with the smallest ``doc_id``.  Rows that repeat a kept ``doc_id`` stay."""
    named = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"))
    found = near_duplicates(docs, shingle, percent)
    dropped = found.where("not kept").select(F.col("doc_id").alias("dropped")).distinct()
    return named.join(dropped, F.col("id") == F.col("dropped"), "left_anti").select("doc.*")
