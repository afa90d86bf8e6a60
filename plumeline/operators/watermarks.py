"""Source watermarks (SNK-9, AGG-8..10, FLT-10, SET-2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.merge import upsert_latest
from plumeline.operators.ranking import first_per_key
from plumeline.schemas import AUTHORITATIVE, PROVISIONAL

KEYS = ("source_name", "watermark_key")
TAIL_PREFIX = "tail_max_ts_utc:"


def upsert_watermarks(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Watermarks after ``updates``; the last write of a key wins, it is not a maximum (SNK-9)."""
    return upsert_latest(existing, latest_watermarks(updates), KEYS)


def latest_watermarks(log: DataFrame) -> DataFrame:
    """Current value per key of an append-only watermark log."""
    return first_per_key(log, KEYS, [F.col("updated_at").desc_nulls_last(), F.col("watermark_value").desc()])


def batch_watermarks(valid: DataFrame) -> DataFrame:
    """Watermarks a batch sets (AGG-9): latest provisional hour, latest authoritative change."""
    provisional = F.col("source_system") == PROVISIONAL
    maxima = valid.agg(
        F.max(F.when(provisional, F.col("timestamp_start_utc"))).alias("hour"),
        F.max(F.when(~provisional, F.col("source_last_modified_date"))).alias("change"),
    )
    rows = F.array(
        F.struct(
            F.lit(PROVISIONAL).alias("source_name"),
            F.lit("latest_completed_hour_utc").alias("watermark_key"),
            fn.iso_text(F.col("hour")).alias("watermark_value"),
        ),
        F.struct(
            F.lit(AUTHORITATIVE).alias("source_name"),
            F.lit("latest_change_date").alias("watermark_key"),
            F.date_format("change", "yyyyMMdd").alias("watermark_value"),
        ),
    )
    return maxima.select(F.explode(rows).alias("w")).select("w.*").where(F.col("watermark_value").isNotNull())


def tail_watermarks(current: DataFrame, regions: DataFrame, pollutants: DataFrame) -> DataFrame:
    """Latest authoritative timestamp per region and pollutant, and overall (AGG-8).

    The fact is reduced to one row per state and pollutant before regions join.
    """
    tails = (
        current.where(F.col("source_system") == AUTHORITATIVE)
        .groupBy(F.split_part("location_id", F.lit(":"), F.lit(2)).alias("state_code"), "pollutant_code")
        .agg(F.max("timestamp_start_utc").alias("tail"))
    )
    states = regions.select("region_id", "state_code").distinct()
    by_region = (
        tails.join(pollutants.select("pollutant_code").distinct(), "pollutant_code", "left_semi")
        .join(states, "state_code")
        .groupBy("region_id", "pollutant_code")
        .agg(F.max("tail").alias("tail"))
        .where(F.col("tail").isNotNull())
    )
    # One grouping set per level: regions by pollutant, and the overall maximum.
    levels = by_region.select(
        F.explode(
            F.array(F.concat_ws(":", "region_id", "pollutant_code"), F.lit("global"))
        ).alias("scope"),
        "tail",
    )
    return levels.groupBy("scope").agg(F.max("tail").alias("tail")).select(
        F.lit(AUTHORITATIVE).alias("source_name"),
        F.concat(F.lit(TAIL_PREFIX), F.col("scope")).alias("watermark_key"),
        fn.iso_text(F.col("tail")).alias("watermark_value"),
    )


def raised_tails(stored: DataFrame, batch_tails: DataFrame) -> DataFrame:
    """Tail watermarks after a batch: per key the later of the stored value and
    the batch's own tail.  Current never loses a key, so this equals a scan of
    the whole current table without reading it."""
    kept = stored.where(
        (F.col("source_name") == AUTHORITATIVE) & F.col("watermark_key").startswith(TAIL_PREFIX)
    ).select("source_name", "watermark_key", "watermark_value")
    later = F.max_by("watermark_value", fn.parse_utc_timestamp(F.col("watermark_value")))
    return kept.unionByName(batch_tails).groupBy("source_name", "watermark_key").agg(later.alias("watermark_value"))


def authoritative_tail(watermarks: DataFrame, current: DataFrame, history: DataFrame) -> DataFrame:
    """One row ``tail``: the maximum stored tail watermark, else the maximum
    timestamp over current and history (AGG-10).

    The fact scans sit behind a join with the one-row check for a watermark: when
    there is one, nothing matches and no fact row leaves its scan.
    """
    stored = watermarks.where(
        (F.col("source_name") == AUTHORITATIVE) & F.col("watermark_key").startswith(TAIL_PREFIX)
    ).agg(F.max(fn.parse_utc_timestamp(F.col("watermark_value"))).alias("tail"))
    # The source name to scan for, NULL (matching nothing) once a tail is stored.
    wanted = stored.select(F.when(F.col("tail").isNull(), AUTHORITATIVE).alias("source_system"))
    facts = current.select("source_system", "timestamp_start_utc").unionByName(
        history.select("source_system", "timestamp_start_utc")
    )
    scanned = (
        facts.where(F.col("source_system") == AUTHORITATIVE)
        .join(F.broadcast(wanted), "source_system", "left_semi")  # one row
        .agg(F.max("timestamp_start_utc").cast("timestamp").alias("tail"))
    )
    return stored.unionByName(scanned).agg(F.max("tail").alias("tail"))


def gap_window(
    tail: DataFrame,
    as_of: datetime | Column,
    *,
    manual_start: datetime | None = None,
    manual_end: datetime | None = None,
    end_lag_hours: int = 1,
    fallback_hours: int = 6,
) -> DataFrame:
    """Hours to fill (ST-2): the manual window; else from the hour after the tail
    to now less the lag; else the fallback hours.  ``is_empty`` flags no work."""
    end = F.date_trunc("hour", fn.as_column(as_of)) - F.make_dt_interval(hours=F.lit(max(0, end_lag_hours)))
    after_tail = F.date_trunc("hour", F.col("tail")) + F.expr("interval 1 hour")
    fallback = end - F.make_dt_interval(hours=F.lit(max(1, fallback_hours) - 1))
    if manual_start is not None and manual_end is not None:
        start, end, used = F.lit(manual_start), F.lit(manual_end), F.lit(None)
    else:
        start, used = F.coalesce(after_tail, fallback), F.col("tail")
    window = tail.select(
        start.cast("timestamp").alias("start_utc"),
        end.cast("timestamp").alias("end_utc"),
        used.cast("timestamp").alias("aqs_tail_utc"),
    )
    return window.withColumn("is_empty", F.col("start_utc") > F.col("end_utc"))


def gap_chunks(window: DataFrame, hours: int = 6) -> DataFrame:
    """The gap window in chunks of ``hours`` (DT-13); no rows when it is empty."""
    chunks = fn.hour_chunks(F.col("start_utc"), F.col("end_utc"), hours)
    return window.select(F.explode(chunks).alias("chunk")).select("chunk.*")


def change_window(
    watermarks: DataFrame,
    as_of: datetime | Column,
    *,
    manual_start: str | None = None,
    manual_end: str | None = None,
    overlap_days: int = 1,
    lookback_days: int = 2,
) -> DataFrame:
    """Change dates to reconcile (ST-3): the manual window, else the checkpoint
    less the overlap, else the lookback, up to today."""
    today = fn.as_column(as_of).cast("date")
    checkpoint = watermarks.where(
        (F.col("source_name") == AUTHORITATIVE) & (F.col("watermark_key") == "reconcile_last_cedate")
    ).agg(fn.parse_iso_date(F.max_by("watermark_value", "updated_at")).alias("checkpoint"))
    if manual_start and manual_end:
        start, end = fn.parse_iso_date(F.lit(manual_start)), fn.parse_iso_date(F.lit(manual_end))
    else:
        start = F.coalesce(
            F.date_sub("checkpoint", max(0, overlap_days)), F.date_sub(today, max(1, lookback_days))
        )
        end = today
    return checkpoint.select(start.alias("start_date"), end.alias("end_date"))


def changed_within(observations: DataFrame, window: DataFrame) -> DataFrame:
    """Observations whose last change falls in a one-row change window."""
    bounds = window.select(F.struct("start_date", "end_date")).scalar()
    changed = F.col("source_last_modified_date")
    return observations.where((changed >= bounds["start_date"]) & (changed <= bounds["end_date"]))
