"""Raw landing: object keys, manifests, change detection, hot window
(SNK-1..3, SRC-4, TOP-2, TOP-3, FLT-11, ST-1, JOIN-12)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.merge import upsert_latest
from plumeline.operators.ranking import first_per_key

# Dataset, key prefix, file extension.
DATASETS = {
    "aqs_sample_json": ("aqs/sample", "json"),
    "aqs_daily_json": ("aqs/daily", "json"),
    "aqs_metadata_json": ("aqs/metadata", "json"),
    "aqs_monitor_metadata_json": ("aqs/monitor-metadata", "json"),
    "airnow_hourly_file": ("airnow/hourly", "dat"),
    "airnow_gapfill_json": ("airnow/gapfill", "json"),
}


def canonical_json(*columns: Column) -> Column:
    """Compact JSON with keys in the given (sorted) order, NULLs kept (SNK-2)."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_hash(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def _dated(prefix: str, ts: Column, name: Column) -> Column:
    return F.concat(
        F.lit(f"{prefix}/year="), F.date_format(ts, "yyyy"),
        F.lit("/month="), F.date_format(ts, "MM"),
        F.lit("/day="), F.date_format(ts, "dd"),
        F.lit("/"), name,
    )


def object_key(dataset: str, extracted_at: Column, sha256: Column) -> Column:
    """Default content-addressed key of a landed object (SNK-1)."""
    if dataset not in DATASETS:
        raise ValueError(f"Unsupported dataset '{dataset}'. Supported: {sorted(DATASETS)}")
    prefix, extension = DATASETS[dataset]
    stamp = F.date_format(extracted_at, "yyyyMMdd'T'HHmmss'Z'")
    return _dated(prefix, extracted_at, F.concat(stamp, F.lit("_"), F.substring(sha256, 1, 12), F.lit("." + extension)))


def hourly_object_key(hour_start: Column, file_name: Column, sha256: Column) -> Column:
    base = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return _dated("airnow/hourly", hour_start, F.concat(base, F.lit("_"), F.substring(sha256, 1, 12), F.lit(".dat")))


def gap_object_key(chunk_start: Column, chunk_end: Column, sha256: Column) -> Column:
    hour = "yyyyMMdd'T'HH"
    name = F.concat(
        F.lit("gap_"), F.date_format(chunk_start, hour), F.lit("_"), F.date_format(chunk_end, hour),
        F.lit("_"), F.substring(sha256, 1, 12), F.lit(".json"),
    )
    return _dated("airnow/gapfill", chunk_start, name)


def hourly_file_name(hour_start: Column) -> Column:
    return F.concat(F.lit("HourlyData_"), F.date_format(hour_start, "yyyyMMddHH"), F.lit(".dat"))


def upsert_manifest(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest after landing: an object key landed again is replaced (SNK-3)."""
    keys = ["dataset", "object_key"]
    newest = first_per_key(landed, keys, [F.col("extracted_at").desc_nulls_last(), F.col("content_sha256").desc()])
    return upsert_latest(manifest, newest, keys)


def current_manifest(log: DataFrame) -> DataFrame:
    """The manifest behind the append-only landing log: the last landing of every object key (SNK-3)."""
    return upsert_manifest(log.where(F.lit(False)), log)


def landed_objects(dataset: str, responses: DataFrame, extracted_at: Column) -> DataFrame:
    """Raw objects and their manifest rows from what a fetch returned (SNK-1).

    ``responses`` holds ``body`` (text or bytes), ``source_url``, ``metadata`` and, for datasets with a key
    layout of their own, ``object_key``.  Responses without a body land nothing; an empty body does.
    """
    sha256 = content_hash(F.col("body"))
    key = F.col("object_key") if "object_key" in responses.columns else object_key(dataset, extracted_at, sha256)
    return responses.where(F.col("body").isNotNull()).select(
        F.lit(dataset).alias("dataset"), key.alias("object_key"), "source_url", sha256.alias("content_sha256"),
        extracted_at.alias("extracted_at"), "metadata", F.make_valid_utf8(F.col("body").cast("string")).alias("body"),
    )


def newest_manifests(manifest: DataFrame, dataset: str, limit: int) -> DataFrame:
    """The ``limit`` most recently landed objects of a dataset (SRC-4, TOP-3)."""
    chosen = manifest.where(F.col("dataset") == dataset)
    return chosen.orderBy(F.col("extracted_at").desc_nulls_first(), F.col("object_key").asc_nulls_last()).limit(limit)


def unstaged_manifests(manifest: DataFrame, staging: DataFrame, dataset: str) -> DataFrame:
    """Landed objects of a dataset that no staged row comes from, or that were landed again
    after the last staging of their rows (SRC-4)."""
    seen = staging.groupBy("object_key").agg(F.max("ingested_at").alias("staged_at"))
    joined = manifest.where(F.col("dataset") == dataset).join(seen, "object_key", "left")
    return joined.where("staged_at is null or extracted_at > staged_at").select(*manifest.columns)


def latest_file_hashes(landed: DataFrame) -> DataFrame:
    """Last landed content hash per file name (TOP-2)."""
    latest = first_per_key(
        landed.select("file_name", "content_sha256", "extracted_at"),
        ["file_name"],
        [F.col("extracted_at").desc_nulls_first(), F.col("content_sha256").desc()],
    )
    return latest.select("file_name", F.col("content_sha256").alias("previous_sha256"))


def changed_files(listing: DataFrame, landed: DataFrame) -> DataFrame:
    """Listed files whose content differs from the last landed one, new ones included (FLT-11)."""
    joined = listing.join(latest_file_hashes(landed), "file_name", "left")
    return joined.where(~F.col("content_sha256").eqNullSafe(F.col("previous_sha256"))).select(*listing.columns)


def hot_window_status(spine: DataFrame, listing: DataFrame, landed: DataFrame) -> DataFrame:
    """Status of every expected hour (ST-1, JOIN-12).

    ``spine`` holds the hours (``hour_start_utc``), ``listing`` what a fetch of
    each file returned (``file_name``, ``http_status`` NULL when the request
    failed, ``content_length``, ``content_sha256``).  An hour that was never
    listed counts as a failed request.
    """
    expected = spine.select("hour_start_utc", hourly_file_name(F.col("hour_start_utc")).alias("file_name"))
    joined = expected.join(listing, "file_name", "left").join(latest_file_hashes(landed), "file_name", "left")
    status = (
        F.when(F.col("http_status").isNull(), "failed")
        .when(F.col("http_status") == 404, "missing")
        .when(F.col("http_status") != 200, "http_error")
        .when(F.coalesce("content_length", F.lit(0)) == 0, "empty")
        .when(F.col("content_sha256") == F.col("previous_sha256"), "no_update")
        .otherwise("written")
    )
    return joined.select("hour_start_utc", "file_name", "http_status", "content_sha256", status.alias("status"))


COMPLETED = ("missing", "empty", "no_update", "written")
# Hour status and the issue type it is reported as.
HOUR_ISSUES = {
    "failed": "airnow_hourly_request_failed",
    "missing": "airnow_hourly_missing_file",
    "http_error": "airnow_hourly_http_error",
    "empty": "airnow_hourly_empty_file",
    "no_update": "airnow_hourly_no_update",
}


def latest_completed_hour(status: DataFrame) -> DataFrame:
    """Last hour that needs no further fetch; missing and empty files count."""
    done = F.col("status").isin(*COMPLETED)
    return status.agg(F.max(F.when(done, F.col("hour_start_utc"))).alias("latest_completed_hour_utc"))


def hour_issues(status: DataFrame, base_url: str = "") -> DataFrame:
    """Data-quality issues of a hot window run, details as JSON."""
    kinds = F.create_map(*[F.lit(x) for pair in HOUR_ISSUES.items() for x in pair])
    detail = F.to_json(
        F.struct(
            F.when(F.col("status") == "no_update", F.col("content_sha256")).alias("content_sha256"),
            "file_name",
            fn.iso_text(F.col("hour_start_utc")).alias("hour_start_utc"),
            F.when(F.col("status").isin("http_error", "empty"), F.col("http_status")).alias("http_status"),
            F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("file_name")).alias("source_url"),
        )
    )
    return status.select(
        kinds[F.col("status")].alias("issue_type"), F.lit(None).cast("string").alias("natural_key"), detail.alias("issue_detail")
    ).where(F.col("issue_type").isNotNull())


def expected_hours(spark, as_of: datetime, hours: int = 48) -> DataFrame:
    """The last ``hours`` complete hours as rows (DT-12)."""
    return spark.range(1).select(F.explode(fn.recent_hours(F.lit(as_of), hours)).alias("hour_start_utc"))
