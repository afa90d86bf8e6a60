"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through a whole normaliser ``m``, so documents of one ``m`` form a
stratum, in which a posting's impact depends on its ``tf`` alone.  The steps are

1. find the terms that the items ask for in every document, with their counts (one pass over the texts);
2. sum up the collection (documents, terms, documents per term);
3. range-partition the found postings by ``m`` and the document's hash, so a stratum of any size is spread over tasks;
4. in each task, sort the postings of a stratum by term and ``tf``, compute impacts once per ``tf``, bound what the stratum
   can give an item by its largest ``tf`` per term, visit strata in the order of their bounds, and stop at the first
   below the item's lowest kept score;
5. rank the best of all tasks per item.

Items are taken in blocks of bounded size; each block is a pass over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch, running_totals
from plumeline.llm.terms import terms

# The scoring rule's fixed values.
SCALE = 1000
LENGTH_SHARE = 25
SATURATION = 12
IMPACT_UNIT = 1_000_000_000

# A block of items has about so much text and so many items.
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 2_000
# A task indexes so many postings at a time.
SEGMENT_POSTINGS = 2_000_000

FOUND = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, item_id long, doc_id long, score long"


class Queries(NamedTuple):
    """Items of a block: ids, and their terms and counts in one array each."""

    ids: list
    terms: np.ndarray
    counts: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, rows: list, vocabulary: dict[bytes, int]) -> Queries:
        """Takes rows ``(item_id, text)``; new terms are added to the vocabulary."""
        flat, counts, offsets = [], [], [0]
        for _, text in rows:
            for term, count in Counter(terms(bytes(text or b""))).items():
                flat.append(vocabulary.setdefault(term, len(vocabulary)))
                counts.append(count)
            offsets.append(len(flat))
        return cls([r[0] for r in rows], *(np.array(x, dtype=np.int64) for x in (flat, counts, offsets)))

    def of_item(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.offsets[item], self.offsets[item + 1])
        return self.terms[part], self.counts[part]


class Stratum:
    """Postings of documents with one normaliser, sorted by term and ``tf``."""

    def __init__(self, m: int, docs: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray):
        self.docs = docs  # rows of the segment
        self.doc = doc - docs[0]
        run = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(tf, prepend=-1))
        seen, which = np.unique(tf[run], return_inverse=True)
        impacts = IMPACT_UNIT * seen // (SCALE * seen + SATURATION * m)  # once per tf
        values = weights[term[run]] * impacts[which]
        self.value = np.repeat(values, np.diff(run, append=len(term)))
        first = np.flatnonzero(np.diff(term, prepend=-1))
        self.term = term[first]
        self.begin, self.end = first, np.append(first[1:], len(term))

    def bounds(self, queries: Queries, dense: np.ndarray) -> np.ndarray:
        """The most that a document here can score, for each item.  ``dense`` is zero for every term, before and after."""
        dense[self.term] = self.value[self.end - 1]
        sums = np.concatenate([[0], np.cumsum(dense[queries.terms] * queries.counts)])
        dense[self.term] = 0
        return np.diff(sums[queries.offsets])

    def scores(self, asked: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores of all documents for one item."""
        at = np.minimum(np.searchsorted(self.term, asked), len(self.term) - 1)
        here = self.term[at] == asked
        begin, end, counts = self.begin[at[here]], self.end[at[here]], counts[here]
        sizes = end - begin
        postings = np.arange(sizes.sum()) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
        found = np.zeros(len(self.docs), dtype=np.int64)
        np.add.at(found, self.doc[postings], self.value[postings] * np.repeat(counts, sizes))
        return found


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        empty = np.empty(0, dtype=np.int64)
        self.kept = [(empty, empty.astype(bool), empty)] * items  # score, whether the id is null, id
        self.floor = np.ones(items, dtype=np.int64)  # lower scores cannot enter

    def add(self, item: int, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor[item]
        columns = [np.concatenate([a, b[good]]) for a, b in zip(self.kept[item], (scores, no_id, ids))]
        order = np.lexsort((columns[2], columns[1], -columns[0]))[: self.k]
        self.kept[item] = tuple(c[order] for c in columns)
        if len(order) == self.k:
            self.floor[item] = columns[0][order[-1]]


def strata(m: np.ndarray, lengths: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray) -> list[Stratum]:
    """Strata of a segment whose documents are sorted by ``m``."""
    doc = np.repeat(np.arange(len(m)), lengths)
    order = np.lexsort((tf, term, m[doc]))
    doc, term, tf = doc[order], term[order], tf[order]
    edges = np.append(np.flatnonzero(np.diff(m, prepend=-1)), len(m))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return [
        Stratum(int(m[a]), np.arange(a, b), doc[ends[a] : ends[b]], term[ends[a] : ends[b]], tf[ends[a] : ends[b]], weights)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())
    ]


def search_segment(segment: list[Stratum], ids: np.ndarray, no_id: np.ndarray, queries: Queries, best: Best, terms_in_all: int) -> None:
    """Visit the strata of a segment for every item, best bound first."""
    dense = np.zeros(terms_in_all, dtype=np.int64)
    bounds = np.array([s.bounds(queries, dense) for s in segment])
    for item in np.flatnonzero((bounds >= best.floor).any(axis=0)).tolist():
        asked, counts = queries.of_item(item)
        for at in np.argsort(-bounds[:, item], kind="stable").tolist():
            if bounds[at, item] < best.floor[item]:
                break
            s = segment[at]
            best.add(item, s.scores(asked, counts), no_id[s.docs], ids[s.docs])


def _find(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = vocabulary.value.get
        for batch in batches:
            sizes, lengths, found, tfs = [], [], [], []
            for text in batch["text"].cast(pa.binary()):
                held = terms(text.as_py())
                asked = np.fromiter(map(look, held, repeat(-1)), dtype=np.int32, count=len(held))
                asked, counts = np.unique(asked[asked >= 0], return_counts=True)
                sizes.append(len(held))
                lengths.append(len(asked))
                found.append(asked)
                tfs.append(counts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*x, empty]).astype(np.int32)))
                for x in (found, tfs)
                for empty in [np.empty(0, dtype=np.int32)]
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


def _rank(queries, weights: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Queries(*queries.value)
        best, held, size = Best(len(asked.ids), k), [], 0

        def solve() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            terms_, tfs = table["terms"].combine_chunks(), table["tfs"].combine_chunks()
            segment = strata(
                table["m"].to_numpy(),
                terms_.value_lengths().to_numpy(),
                terms_.flatten().to_numpy().astype(np.int64),
                tfs.flatten().to_numpy().astype(np.int64),
                weights,
            )
            ids = table["doc_id"]
            search_segment(segment, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(), asked, best, len(weights))

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                held.append(part)
                size += len(part["terms"].flatten())
                if size >= SEGMENT_POSTINGS:
                    solve()
                    held, size = [], 0
        if held:
            solve()
        names = [f.split()[0] for f in BEST.split(", ")]
        for item, (scores, no_id, ids) in enumerate(best.kept):
            if len(scores):
                fixed = [pa.array([item] * len(ids), pa.int32()), pa.array([asked.ids[item]] * len(ids), pa.int64())]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(ids, mask=no_id), pa.array(scores)], names=names)

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents that score highest for every item: ``item_id, rank, doc_id, score``.

    ``docs`` needs ``doc_id, text`` and ``items`` needs ``item_id, text``; other columns are ignored.  Equal scores rank by
    ascending id, null ids last; repeated documents rank each and repeated items are answered each.  Null and empty
    texts have no terms; items that meet no document, and empty tables, give no rows.  The driver holds one block of items
    and the counts of its terms, both bounded by ``BLOCK_BYTES`` and the longest item.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.encode("text", "UTF-8").alias("text"))
    asked = scratch.save(asked.withColumns({"row": F.monotonically_increasing_id(), "one": F.lit(1)}).withColumn(
        "bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    ))
    placed = running_totals(asked, [F.col("row")], "bytes", scratch).withColumnRenamed("before", "bytes_before")
    placed = scratch.save(running_totals(scratch.save(placed), [F.col("row")], "one", scratch))
    block = F.concat_ws(".", F.floor(F.col("bytes_before") / BLOCK_BYTES), F.floor(F.col("before") / BLOCK_ITEMS))
    placed = placed.withColumn("block", block)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    answers = []
    for (name,) in placed.select("block").distinct().collect():
        rows = [(r["item_id"], r["text"]) for r in placed.where(F.col("block") == name).orderBy("row").collect()]
        answers.append(_search_block(named, rows, k, scratch))
    if not answers:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, answers)


def _search_block(docs: DataFrame, rows: list, k: int, scratch: Scratch) -> DataFrame:
    context = docs.sparkSession.sparkContext
    vocabulary: dict[bytes, int] = {}
    queries = Queries.of(rows, vocabulary)
    found = docs.mapInArrow(_find(context.broadcast(vocabulary)), FOUND)
    found = scratch.save(found.withColumn("row", F.monotonically_increasing_id()))
    with_terms, all_terms = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    holding = found.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in holding.collect():
        weights[term] = math.floor(SCALE * math.log((2 * with_terms + 2) / (2 * df + 1)))
    share = f"cast({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {with_terms}L) div {max(all_terms or 0, 1)}L as long)"
    held = found.where(F.size("terms") > 0).withColumn("m", F.expr(share))
    keys = ["m", F.xxhash64("doc_id"), "row"]
    ordered = held.repartitionByRange(*keys).sortWithinPartitions("m").select("doc_id", "m", "terms", "tfs")
    best = ordered.mapInArrow(_rank(context.broadcast(tuple(queries)), weights, k), BEST)
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
