"""Importance resampling towards a target collection, on bit-sliced bucket counts.

Features (runs of words) fall into ``buckets`` buckets by CRC-32.  A bucket's gain is the scaled
log ratio of its share in the target to its share in the corpus; a document's weight is the sum of the gains
of its features.  Here a document is a few bit planes, plane ``p`` holding bit ``p`` of every bucket's count, and the
gains are signed planes: bit ``q`` of the positive and of the negative gains.  Then

    weight = sum over p, q of 2 ** (p + q) * (popcount(plane p & positive q) - popcount(plane p & negative q))

is exact in whole numbers.  Adding Gumbel noise from a seeded digest of the id and drawing the highest scores
samples without replacement in proportion to ``exp(weight / 1000)``.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch, running_totals
from plumeline.llm.terms import terms

BUCKETS = 10_000
SCALE = 1000
MAX_CACHED_WORDS = 300_000


class BucketOf(dict):
    """Bucket of a feature's UTF-8 bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(found: list[bytes], longest: int) -> Iterator[bytes]:
    """All runs of one to ``longest`` consecutive words, joined by one space."""
    yield from found
    for size in range(2, longest + 1):
        for i in range(len(found) - size + 1):
            yield b" ".join(found[i : i + size])


def bucket_counts(found: list[bytes], table: BucketOf, longest: int) -> np.ndarray:
    """How many features fall into each bucket."""
    count = sum(max(len(found) - size + 1, 0) for size in range(1, longest + 1))
    at = np.fromiter(map(table.__getitem__, features(found, longest)), dtype=np.int64, count=count)
    return np.bincount(at, minlength=table.buckets)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers from 0 on, lowest bit first: a row of 64-bit words for each."""
    top = int(values.max(initial=0)).bit_length()
    values = values.astype(np.uint16 if top <= 16 else np.uint64)
    wide = np.zeros((top, -(-len(values) // 64) * 64), dtype=bool)
    for bit in range(top):
        wide[bit, : len(values)] = (values >> bit) & 1
    return np.packbits(wide, axis=1).view(np.uint64)


class GainPlanes(NamedTuple):
    """Signed bit planes of the gains, positive ones above negative ones, and what a bit of each plane counts."""

    bits: np.ndarray
    worth: np.ndarray

    @classmethod
    def of(cls, gains: np.ndarray) -> GainPlanes:
        positive, negative = planes(np.maximum(gains, 0)), planes(np.maximum(-gains, 0))
        worth = [1 << q for q in range(len(positive))] + [-(1 << q) for q in range(len(negative))]
        return cls(np.concatenate([positive, negative]), np.array(worth, dtype=np.int64))


def weigh(document: np.ndarray, gains: GainPlanes) -> int:
    """The sum of counts times gains, from planes alone."""
    total = 0
    for bit, plane in enumerate(document):
        ones = np.bitwise_count(gains.bits & plane).sum(axis=1, dtype=np.int64)
        total += int(ones @ gains.worth) << bit
    return total


def gain_table(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Scaled log ratios per bucket, one count added to each bucket of both sides."""
    buckets, t_all, s_all = len(target), int(target.sum()), int(corpus.sum())
    return np.array(
        [
            math.floor(SCALE * math.log(float(t + 1) * (s_all + buckets) / (float(s + 1) * (t_all + buckets))))
            for t, s in zip(target.tolist(), corpus.tolist())
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Scaled Gumbel noise from the id's digest."""
    name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(name).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def corpus_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features per bucket of all of ``texts (text)``; what reaches the driver has ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = BucketOf(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].cast(pa.binary()):
                sums += bucket_counts(terms(text.as_py()), table, longest)
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(sums[hit])], names=["bucket", "n"])

    parts = texts.select("text").mapInArrow(count, "bucket long, n long")
    found = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    buckets: int = BUCKETS,
    longest: int = 1,
    seed: int = 2024,
) -> DataFrame:
    """Every document's ``doc_id, n_features, weight, score, rank, n_words``; ``rank`` counts the drawn ones from 1 and is
    null for others.

    ``docs`` needs ``doc_id, text`` and ``target`` needs ``text``; other columns are ignored.  Of the documents with
    ``least_words`` words, ``percent`` in a hundred (rounded down) with the highest scores are drawn, ties to the
    smaller id, null ids last, repeated rows each.  Null and empty texts have no features and weight 0; a null id
    takes the noise of an empty one.  An empty target gives every bucket the gain of no occurrence; an
    empty table gives no rows.  The only data that passes the driver is a count per bucket.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    gains = GainPlanes.of(gain_table(corpus_counts(target, buckets, longest), corpus_counts(docs, buckets, longest)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = BucketOf(buckets)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                found = terms(text.as_py())
                counts = bucket_counts(found, table, longest)
                weight = weigh(planes(counts), gains)
                rows.append((doc_id, int(counts.sum()), weight, weight + noise(doc_id, seed), len(found)))
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "n_features", "weight", "score", "n_words"]
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    scored = named.mapInArrow(judge, "doc_id long, n_features long, weight long, score long, n_words long")
    able = (F.col("n_words") >= least_words).cast("long")
    scored = scratch.save(scored.withColumns({"able": able, "row": F.monotonically_increasing_id()}))
    drawn = (scored.agg(F.sum("able")).first()[0] or 0) * percent // 100
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = running_totals(scored, order, "able", scratch)
    rank = F.when((F.col("able") == 1) & (F.col("before") < drawn), F.col("before") + 1)
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), "n_words")
