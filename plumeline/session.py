"""Session settings and the two size / location checks that plans rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job of this package assumes.  Timestamps are UTC wall time;
# AQE re-plans joins, splits skewed partitions and coalesces small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles methods above 8000 bytes.  Feed parsing generates
    # larger ones when fused into one stage; below this limit Spark runs those
    # operators with split-up generated projections instead (several times faster).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "plumeline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply to a session built elsewhere what results (UTC) and feed parsing
    (method size) depend on."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_dir(spark: SparkSession, fallback: str) -> str:
    """Folder for intermediate tables: the one the cluster names, else ``fallback``.

    ``spark.checkpoint.dir`` is on storage every executor can reach, so tables
    written there outlive lost executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or fallback).rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; on one machine, where none is set, a new temporary one, which is then set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="plumeline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside free the shuffle files of their plan as they end.  Left to the driver's garbage collector, the shuffles
    of all steps of a job would lie on the executors' disks together."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def broadcast_if_small(df: DataFrame, bounded_by: DataFrame | None = None) -> DataFrame:
    """Hint ``df`` for broadcast only when a size check passes.

    ``bounded_by`` names the table that bounds the row count of ``df`` (a
    dimension built by key lookups has at most the rows of its driving table);
    without it ``df`` itself is measured.  The planner's own estimate is
    compared with ``spark.sql.autoBroadcastJoinThreshold``.  Above it ``df`` is
    returned without a hint, i.e. a sort-merge join that AQE may still split
    on skew or convert at run time.
    """
    return F.broadcast(df) if fits_broadcast(bounded_by if bounded_by is not None else df) else df


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's estimate of ``df`` is within the session's threshold for broadcasts."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        max_bytes = _size_in_bytes(limit)
        estimated = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no JVM handle (remote session) or unreadable setting
        return False
    return 0 <= estimated <= max_bytes


def _size_in_bytes(text: str) -> int:
    text = text.strip().lower()
    for suffix, power in (("tb", 40), ("gb", 30), ("mb", 20), ("kb", 10), ("t", 40), ("g", 30), ("m", 20), ("k", 10), ("b", 0)):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * (1 << power))
    return int(text)
