"""Upserts, source-priority merge, versions and revision audit (MRG-1..6, SNK-4, SNK-8).

All functions are lazy and take the tables as DataFrames.  Rankings keep one
row per key before shuffling; joins are on full keys, so the rows of one hot
``natural_key`` are either reduced first or split by AQE's skew handling.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.functions import as_column
from plumeline.operators.ranking import first_per_key
from plumeline.schemas import PROVISIONAL

VERSION_KEYS = ("natural_key", "record_hash", "source_system")


def by_key(rows: DataFrame) -> DataFrame:
    """``rows`` with those of a natural key in one task, for plans that rank and join them by key many times.

    The other columns are generated after the shuffle, so readers of different columns share it, and rankings and joins
    by key, or by key and more, need none of their own.  All columns given are shuffled; give those that are read.
    """
    others = [c for c in rows.columns if c != "natural_key"]
    return rows.repartition("natural_key").select("natural_key", F.inline(F.array(F.struct(*others)))).select(*rows.columns)


def upsert_latest(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` replace rows of ``base`` with the same keys (MRG-1)."""
    kept = base.join(delta.select(*keys), list(keys), "left_anti")
    return kept.select(*base.columns).unionByName(delta.select(*base.columns))


def insert_ignore(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Rows of ``new`` whose keys are not stored yet, one per key (SNK-4).

    ``order`` decides between new rows sharing a key; without it they are taken
    to be equal.
    """
    unique = first_per_key(new, keys, order) if order else new.dropDuplicates(list(keys))
    return unique.join(existing.select(*keys), list(keys), "left_anti").select(*new.columns)


def latest_staged(staged: DataFrame) -> DataFrame:
    """Newest staged row per (natural_key, record_hash) (WIN-3); ties by object and row hash."""
    return first_per_key(
        staged,
        ["natural_key", "record_hash"],
        [
            F.col("ingested_at").desc_nulls_first(),
            *[F.col(c).asc_nulls_last() for c in ("object_key", "source_row_hash") if c in staged.columns],
        ],
    )


def batch_winners(incoming: DataFrame) -> DataFrame:
    """The row of a batch that competes for each natural key (MRG-2)."""
    return first_per_key(
        incoming,
        ["natural_key"],
        [
            F.col("source_priority").desc(),
            F.col("timestamp_start_utc").desc_nulls_last(),
            F.col("source_last_modified_date").desc_nulls_last(),
            F.col("record_hash").desc(),
        ],
    )


def upsert_current(current: DataFrame, incoming: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Current table after a batch (MRG-3).

    A winner enters when its key is new, its priority is higher, or priorities
    are equal and the hash differs; ``updated_at`` moves only then.
    """
    columns = current.columns
    updated = as_column(as_of).cast(current.schema["updated_at"].dataType)
    winners = batch_winners(incoming).withColumn("updated_at", updated).select(*columns)
    rows = current.withColumn("_new", F.lit(False)).unionByName(winners.withColumn("_new", F.lit(True)))
    # A window, not an outer join: columns nobody reads are not shuffled, and the rows of a key stay in one task.
    of_key = Window.partitionBy("natural_key")
    new = {c: F.first(F.when(F.col("_new"), F.col(c)), ignorenulls=True).over(of_key) for c in columns}
    outranks = new["source_priority"] > F.col("source_priority")
    revises = (new["source_priority"] == F.col("source_priority")) & (new["record_hash"] != F.col("record_hash"))
    keyed = F.col("natural_key").isNotNull()
    takes = ~F.col("_new") & keyed & F.coalesce(outranks | revises, F.lit(False))
    merged = rows.select(
        "natural_key",
        *[F.when(takes, new[c]).otherwise(F.col(c)).alias(c) for c in columns if c != "natural_key"],
        (F.col("_new") & keyed & F.max(~F.col("_new")).over(of_key)).alias("_met"),
    )
    return merged.where(~F.col("_met")).select(*columns)


def history_winners(history: DataFrame) -> DataFrame:
    """Highest priority, then most recently ingested version per key (WIN-4)."""
    recency = [F.col("ingested_at").desc_nulls_first()]
    if "batch_id" in history.columns:
        recency.append(F.col("batch_id").desc_nulls_first())
    return first_per_key(
        history, ["natural_key"], [F.col("source_priority").desc_nulls_first(), *recency, F.col("record_hash").desc()]
    )


def rebuild_current(history: DataFrame, as_of: datetime | Column, current: DataFrame | None = None) -> DataFrame:
    """Current table rebuilt from history (MRG-4); keys only in ``current`` stay."""
    kind = current.schema["updated_at"].dataType if current is not None else "timestamp"
    winners = history_winners(history).withColumn("updated_at", as_column(as_of).cast(kind))
    if current is None:
        return winners.drop("ingested_at", "batch_id")
    return upsert_latest(current, winners.select(*current.columns), ["natural_key"])


def new_history_rows(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming versions not in history yet (SNK-8, JOIN-5)."""
    # A window, not an anti join: it is content with rows that lie together by natural key alone.
    stored = history.select(*VERSION_KEYS).withColumn("_stored", F.lit(True))
    rows = incoming.withColumn("_stored", F.lit(False)).unionByName(stored, allowMissingColumns=True)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in VERSION_KEYS])
    known = complete & F.max("_stored").over(Window.partitionBy(*VERSION_KEYS))
    return rows.select("*", known.alias("_known")).where(~F.col("_stored") & ~F.col("_known")).select(*incoming.columns)


def _same(one: str, other: str) -> Column:
    """Equality of two columns as a condition of a join by natural key; ``==`` would become a key of the join and with it of its shuffle."""
    return (F.col(one) >= F.col(other)) & (F.col(one) <= F.col(other))


def _join_versions(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """``rows`` with the columns of the ``versions`` they are; NULL where there is none.

    The natural key alone is the key of the join, so rows that lie together by it are not shuffled again.  ``versions``
    are those of a current table, of which a natural key has one.
    """
    found = versions.withColumnsRenamed({c: f"_{c}" for c in VERSION_KEYS})
    matches = reduce(lambda a, b: a & b, [_same(c, f"_{c}") for c in VERSION_KEYS[1:]], F.col("natural_key") == F.col("_natural_key"))
    return rows.join(found, matches, "left").drop(*[f"_{c}" for c in VERSION_KEYS])


def with_current_flags(history: DataFrame, current: DataFrame) -> DataFrame:
    """``is_current_version`` derived for all versions (MRG-5, JOIN-11).

    Deriving the flag on read makes it consistent with ``current`` by
    construction and leaves history append-only.
    """
    versions = current.select(*VERSION_KEYS).withColumn("_current", F.lit(True))
    joined = _join_versions(history.drop("is_current_version"), versions)
    return joined.withColumn("is_current_version", F.coalesce("_current", F.lit(False))).drop("_current")


def refresh_current_flags(flagged: DataFrame, current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored flags after a batch: reset and set for the keys of the batch only
    (MRG-5 incremental, JOIN-7, AGG-15); other rows keep theirs."""
    touched = incoming.select("natural_key").distinct().withColumn("_touched", F.lit(True))
    versions = (
        current.join(touched.select("natural_key"), "natural_key", "left_semi")
        .select(*VERSION_KEYS)
        .withColumn("_current", F.lit(True))
    )
    joined = _join_versions(flagged.join(touched, "natural_key", "left"), versions)
    flag = F.when(F.col("_touched"), F.coalesce("_current", F.lit(False))).otherwise(F.col("is_current_version"))
    return joined.withColumn("is_current_version", flag).select(*flagged.columns)


def revision_audit(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Provisional values revised by the batch, against current *before* the
    upsert (MRG-6, JOIN-6); one row per incoming version."""
    old = current.where(F.col("source_system") == PROVISIONAL).select(
        "natural_key",
        F.col("value_numeric").alias("old_value"),
        F.col("record_hash").alias("old_hash"),
        F.col("source_priority").alias("_old_priority"),
    )
    new = incoming.where(F.col("source_system") == PROVISIONAL).select(
        "natural_key",
        F.col("value_numeric").alias("new_value"),
        F.col("record_hash").alias("new_hash"),
        F.col("source_priority").alias("_new_priority"),
    )
    revised = new.join(old, "natural_key").where(
        _same("_old_priority", "_new_priority") & (F.col("old_hash") != F.col("new_hash"))
    )
    return revised.select("natural_key", "old_value", "new_value", "old_hash", "new_hash")


def map_key_granularity(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Opt-in: key granularities as others (``{"sample": "hourly"}``), so that an
    authoritative sample and a provisional hour of one site and time compete for
    one key.  By default granularity separates them."""
    key = reduce(
        lambda acc, item: acc.when(
            F.col("data_granularity") == item[0],
            F.regexp_replace("natural_key", rf"^((?:[^|]*\|){{3}}){re.escape(item[0])}\|", f"$1{item[1]}|"),
        ),
        mapping.items(),
        F.when(F.lit(False), F.col("natural_key")),
    )
    return df.withColumn("natural_key", key.otherwise(F.col("natural_key")))
