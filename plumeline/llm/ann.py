"""Nearest neighbours over learned partitions.

A bounded sample is turned into a graph of nearest neighbours; the graph is cut into
partitions of equal size that cross few edges, and a small network learns to tell a vector's
partition from its coordinates.  Every row of the table is indexed under its most probable
partition; a query visits its several most probable ones and is compared with their rows
exactly.  How many are visited is read off the sample: the fewest that find
``TARGET_RECALL`` of true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch, hash_sample

#: Rows the model is fitted on, about (twice as many at most).
SAMPLE_ROWS = 6000
ROWS_PER_PARTITION = 100
GRAPH_DEGREE = 20
HIDDEN = 96
TARGET_RECALL = 0.97
#: Index rows that are compared with queries at once.
BLOCK_ROWS = 4096


@dataclass
class Router:
    """The fitted network and the number of partitions to visit."""

    mean: np.ndarray
    scale: float
    first: tuple[np.ndarray, np.ndarray]
    second: tuple[np.ndarray, np.ndarray]
    probes: int = 1

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        inner = np.maximum((vectors - self.mean) * self.scale @ self.first[0] + self.first[1], 0)
        return inner @ self.second[0] + self.second[1]

    def visit(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable partitions of each vector, best first."""
        return np.argsort(-self.scores(vectors), axis=1, kind="stable")[:, :count]


def _neighbours(vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows with the largest inner products of each row, itself left out."""
    found = []
    for at in range(0, len(vectors), 1024):
        score = vectors[at : at + 1024] @ vectors.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        best = np.argpartition(-score, k - 1, axis=1)[:, :k]
        found.append(best)
    return np.concatenate(found)


def balanced_partition(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Partition numbers of the graph's nodes: repeated median cuts along the widest direction,
    then moves to the partition that holds most neighbours, within 5 percent of equal size."""
    label = np.zeros(len(vectors), dtype=np.int64)
    pieces = [(np.arange(len(vectors)), parts)]
    number = 0
    while pieces:
        rows, share = pieces.pop()
        if share == 1:
            label[rows] = number
            number += 1
            continue
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = rows[np.argsort(centred @ axes[:, -1], kind="stable")]
        half = share // 2
        cut = len(order) * half // share
        pieces += [(order[:cut], half), (order[cut:], share - half)]
    limit = int(np.ceil(1.05 * len(vectors) / parts))
    nodes = np.arange(len(vectors))
    for _ in range(rounds):
        votes = np.zeros((len(vectors), parts), dtype=np.float32)
        for column in graph.T:
            votes[nodes, label[column]] += 1
            np.add.at(votes, (column, label), 1)
        best = votes.argmax(axis=1)
        gain = votes[nodes, best] - votes[nodes, label]
        size = np.bincount(label, minlength=parts)
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            if size[best[node]] < limit:
                size[label[node]] -= 1
                size[best[node]] += 1
                label[node] = best[node]
    return label


def fit(vectors: np.ndarray, neighbours: int = 20) -> Router:
    """Router fitted on a sample; few rows give a single partition."""
    n, width = vectors.shape
    mean = vectors.mean(axis=0)
    spread = float(np.sqrt(((vectors - mean) ** 2).mean()))
    scale = 1 / spread if spread > 0 and np.isfinite(1 / spread) else 1.0
    parts = max(1, n // ROWS_PER_PARTITION)
    random = np.random.default_rng(7)
    if parts == 1 or n <= neighbours + 1:
        return Router(mean, scale, (np.zeros((width, 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1)))
    graph = _neighbours(vectors, min(GRAPH_DEGREE, n - 1))
    label = balanced_partition(vectors, graph, parts)
    wanted = np.zeros((n, parts))
    wanted[np.arange(n), label] = 0.5
    for column in graph.T:
        np.add.at(wanted, (np.arange(n), label[column]), 0.5 / graph.shape[1])
    hidden = min(HIDDEN, 4 * parts)
    weights = [
        random.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden),
        random.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts),
    ]
    means, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    inputs = (vectors - mean) * scale
    for _ in range(25):
        order = random.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            x, y = inputs[rows], wanted[rows]
            inner = np.maximum(x @ weights[0] + weights[1], 0)
            out = inner @ weights[2] + weights[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - y) / len(rows)
            back = (error @ weights[2].T) * (inner > 0)
            grads = [x.T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m, s in zip(weights, grads, means, squares):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    router = Router(mean, scale, (weights[0], weights[1]), (weights[2], weights[3]))
    ranks = np.argsort(np.argsort(-router.scores(vectors), axis=1, kind="stable"), axis=1)
    home = ranks.argmin(axis=1)
    near = _neighbours(vectors, min(neighbours, n - 1))
    seen = np.sort(ranks[np.arange(n)[:, None], home[near]].ravel())
    router.probes = int(seen[min(len(seen) - 1, int(np.ceil(TARGET_RECALL * len(seen))))]) + 1
    return router


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _routed(router: Router, queries: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            visited = router.visit(_matrix(batch["vector"]), router.probes if queries else 1)
            rows = np.repeat(np.arange(batch.num_rows), visited.shape[1])
            out = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(visited.ravel().astype(np.int32))], names=[*batch.schema.names, "part"]
            )

    return run


def _compare(k: int):
    """Rows arrive by (part, block), the index rows of a block before the queries."""

    def best(ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, hashes: np.ndarray, queries: np.ndarray) -> list[pa.Array]:
        score = queries @ block.T
        keep = min(len(ids), k + 8)
        out: list[list] = [[], [], [], []]
        near = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        for q in range(len(queries)):
            rows = near[q]
            # Rows that tie with the last one kept are candidates too.
            edge = score[q, rows].min()
            if keep < len(ids):
                rows = np.flatnonzero(score[q] >= edge - 1e-9 * max(1.0, abs(edge)))
            rows = rows[ids[rows] != query_ids[q]]
            exact = (block[rows] * queries[q]).sum(axis=1)
            order = np.lexsort((ids[rows], -exact))[:k]
            out[0] += [int(query_ids[q])] * len(order)
            out[1] += [int(hashes[q])] * len(order)
            out[2] += ids[rows][order].tolist()
            out[3] += exact[order].tolist()
        return [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, vectors = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in ("part", "block", "is_query")])
            starts = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            for a, b in zip([0, *starts.tolist()], [*starts.tolist(), batch.num_rows]):
                part, block, is_query = keys[:, a].tolist()
                run_of = batch.slice(a, b - a)
                if (part, block) != group:
                    group, ids, vectors = (part, block), [], []
                if not is_query:
                    ids.append(run_of["vec_id"].to_numpy())
                    vectors.append(_matrix(run_of["vector"]))
                elif ids:
                    if len(ids) > 1:
                        ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    for at in range(0, b - a, 256):
                        some = run_of.slice(at, 256)
                        found = best(
                            ids[0], vectors[0], some["vec_id"].to_numpy(), some["hash"].to_numpy(), _matrix(some["vector"])
                        )
                        yield pa.RecordBatch.from_arrays(found, names=["query_id", "hash", "vec_id", "score"])

    return run


def nearest(
    table: DataFrame, is_query: str, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The ``k`` found nearest of every query row: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``vec_id``; all rows but those with the query's id are
    candidates.  Nearest is the largest inner product in double precision, ties go to the
    smaller id.  Null vectors and ids, zero vectors and vectors with null or non-finite
    components take no part; vectors of another length are searched among their own; rows that repeat id and
    vector count once; other columns are ignored.  Of equal vectors only the ``k + 1`` with the
    smallest ids can be among the nearest ``k``, and only these are compared.  No rows give no rows.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "ann")
    fine = "forall(vector, x -> x is not null and not isnan(x) and abs(x) <> double('infinity')) and exists(vector, x -> x <> 0)"
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null and vector is not null").where(fine).withColumn("hash", F.xxhash64("vector"))
    rows = scratch.save(rows.dropDuplicates(["vec_id", "hash", "vector"]))
    widths = [r[0] for r in rows.select(F.size("vector")).distinct().collect()]
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    answers = [_nearest(rows.where(F.size("vector") == width), is_query, k, sample_rows, scratch) for width in sorted(widths)]
    return reduce(DataFrame.union, answers)


def _nearest(rows: DataFrame, is_query: str, k: int, sample_rows: int, scratch: Scratch) -> DataFrame:
    """:func:`nearest` of checked rows ``vec_id, vector, hash`` of one length."""
    sample = sorted(hash_sample(rows, F.xxhash64("vec_id", "hash"), sample_rows).select("vec_id", "vector").collect())
    router = fit(np.array([r["vector"] for r in sample]), k)

    alike = W.partitionBy("hash", "vector").orderBy("vec_id")
    chosen = rows.withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= k + 1).drop("nth")
    shape = "vec_id long, vector array<double>, hash long, part int"
    index = scratch.save(chosen.select("vec_id", "vector", "hash").mapInArrow(_routed(router, False), shape))
    blocks = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    blocks = F.broadcast(blocks)  # at most SAMPLE_ROWS / ROWS_PER_PARTITION rows
    dealt = index.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("is_query"), "vec_id", "hash", "vector"
    )
    asked = rows.where(is_query).select("vec_id", "vector", "hash").mapInArrow(_routed(router, True), shape)
    asked = asked.join(blocks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("is_query"), "vec_id", "hash", "vector"
    )
    met = dealt.union(asked).repartition("part", "block").sortWithinPartitions("part", "block", "is_query")
    found = met.mapInArrow(_compare(k), "query_id long, hash long, vec_id long, score double")
    best = W.partitionBy("query_id", "hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
