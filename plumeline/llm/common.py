"""Helpers shared by the training-data operators.

* :class:`Scratch` cuts lineage with a Parquet table in the folder that
  ``spark.checkpoint.dir`` names, so lost executors cost one step, not the plan;
* :func:`components` labels connected components of an edge table with joins
  and aggregates only;
* :func:`running_totals` sums what sorts ahead of each row, over all partitions;
* :func:`words` is the one definition of a word used by all text operators.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contract's word: a run of characters that are neither space nor \t..\r.
WORD_GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is set and all runs on one machine (tests) a fresh
    temporary folder, which is then set for the session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="plumeline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


class Scratch:
    """Intermediate tables of one operator run, in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return the written table."""
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch_path = path
        return saved

    def drop(self, df: DataFrame) -> None:
        """Delete a table returned by :meth:`save` that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(conf).delete(path, True)


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, those whose 64-bit hash ``key`` lies in the lowest part of its range;
    all of a shorter table.  Nothing is sorted, and rows with one hash count once."""
    hashed = df.withColumn("_key", key)
    total = hashed.count()
    if total > rows:
        hashed = hashed.where(F.col("_key") < int(-(2**63) + 2**64 * rows / total))
    return hashed.dropDuplicates(["_key"]).limit(2 * rows).drop("_key")


def symmetric(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, without repeats and loops."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges (u, v)``: one row ``(node, component)`` per
    node that has an edge to another, ``component`` the smallest node reachable.

    Alternating star contraction: in a round every node first links its larger
    neighbours to its smallest neighbour, then its smaller neighbours to the
    smallest of them.  Both steps keep connectivity; the number of rounds is
    logarithmic in practice and the edge count never grows.  Minima are combined
    before the shuffle, and joins on a hot node are ordinary shuffle joins that
    AQE can split.  Null ends and loops are ignored; no edges give no rows.
    """
    current = scratch.save(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    mark = _fingerprint(current)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        large = scratch.save(_large_star(current))
        small = scratch.save(_small_star(large))
        scratch.drop(current)
        scratch.drop(large)
        current, before, mark = small, mark, _fingerprint(small)
        if mark == before:
            break
    else:
        raise RuntimeError("connected components did not converge")
    stars = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.union(current.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest of the node and its neighbours."""
    both = symmetric(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v")
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node itself, go to the smallest of them.
    Edges are (smaller, larger)."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("m"), F.col("u").alias("node"))
    return (
        moved.union(least.select("m", F.col("v").alias("node")))
        .where("m <> node")
        .select(F.least("m", "node").alias("u"), F.greatest("m", "node").alias("v"))
        .distinct()
    )


def running_totals(df: DataFrame, order: list[Column], value: str, scratch: Scratch) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` (whole, not negative) over all rows
    that sort ahead.  Rows are range-partitioned and summed within their partitions;
    what is broadcast has one row per partition.  ``df`` should be a written table, as the
    range bounds are sampled from it first."""
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_run", T.LongType())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = batch[value].to_numpy(zero_copy_only=False).astype(np.int64)
            run = total + np.cumsum(values) - values
            total += int(values.sum())
            columns = [*batch.columns, pa.array(np.full(len(run), part)), pa.array(run)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    parts = scratch.save(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, schema))
    totals = parts.groupBy("_part").agg(F.max(F.col("_run") + F.col(value)).alias("sum"))
    ahead = totals.select(
        "_part", F.coalesce(F.sum("sum").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead")
    )
    return parts.join(F.broadcast(ahead), "_part").withColumn("before", F.col("_run") + F.col("ahead")).drop("_part", "_run", "ahead")
