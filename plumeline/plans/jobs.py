"""The jobs around a load: landing, reading windows, issues, watermarks, readiness
(ST-1..3, SNK-1, SNK-10..12, TOP-4).

What a fetch returned arrives as a DataFrame; fetching itself is not Spark work.  A job has one batch
number; repeated with it after a failure, it goes on with the responses it was first given.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators import landing, ledger, watermarks
from plumeline.plans.load import land, record_issues, record_run, run_load, stage_landed
from plumeline.plans.refresh import refresh_marts
from plumeline.schemas import AUTHORITATIVE, PROVISIONAL
from plumeline.sources.store import ObservationStore

# Job names of the run ledger.
HOT_SYNC = "airnow_hourly_hot_sync"
GAP_FILL = "airnow_gap_bootstrap_manual"
RECONCILE = "aqs_daily_reconcile"
BOOTSTRAP = "aqs_bootstrap_manual"
REFRESH = "serving_rollups_daily"
AUTHORITATIVE_DATASETS = {"aqs_sample_json": "aqs_sample", "aqs_daily_json": "aqs_daily"}


def _mark(row: DataFrame, source: str, key: str, value) -> DataFrame:
    marked = row.select(F.lit(source).alias("source_name"), F.lit(key).alias("watermark_key"), value.alias("watermark_value"))
    return marked.where(F.col("watermark_value").isNotNull())


def _fail(store: ObservationStore, batch_id: int, job: str, as_of: datetime, issues: DataFrame, message: str) -> None:
    record_issues(store, batch_id, as_of, issues)
    record_run(store, batch_id, job, as_of, "failed", message)
    raise RuntimeError(message)


def hot_sync(
    store: ObservationStore,
    batch_id: int,
    as_of: datetime,
    responses: DataFrame,
    *,
    hours: int = 48,
    base_url: str = "",
    regions: DataFrame | None = None,
) -> dict[str, int]:
    """Land the changed hourly files of the last ``hours`` hours and load them (ST-1).

    ``responses``: ``file_name, http_status`` (NULL when the request failed), ``body``.  Every hour that is not
    written gives an issue; the last completed hour becomes a watermark.  If every request
    failed, the job fails after recording that.
    """
    known = store.claim_batch(batch_id, HOT_SYNC)
    if "counters" in known:
        return known["counters"]
    run = store.run_name(HOT_SYNC, batch_id, "responses")
    got = store.once(run, "responses", responses.select("file_name", "http_status", "body"))
    listing = got.select(
        "file_name", "http_status", F.octet_length("body").alias("content_length"), landing.content_hash(F.col("body")).alias("content_sha256")
    )
    expected = landing.expected_hours(store.spark, as_of, hours)
    # Of the whole log only the landings of the expected files, one row an hour, are ranked.
    names = expected.select(landing.hourly_file_name(F.col("hour_start_utc")).alias("name"))
    log = store.read("manifest").where(F.col("dataset") == "airnow_hourly_file")
    log = log.join(F.broadcast(names), F.col("metadata")["file_name"] == F.col("name"), "left_semi")
    landed = landing.current_manifest(log).select(F.col("metadata")["file_name"].alias("file_name"), "content_sha256", "extracted_at")
    # Written before anything lands: a repeated job must not see its own files as unchanged.
    status = store.once(run, "status", landing.hot_window_status(expected, listing, landed))
    issues = landing.hour_issues(status, base_url)
    if status.where("status <> 'failed'").isEmpty():
        _fail(store, batch_id, HOT_SYNC, as_of, issues, "hourly extraction failed for all files")
    changed = status.where("status = 'written'").join(got.select("file_name", "body"), "file_name")
    metadata = F.create_map(
        F.lit("file_name"), F.col("file_name"), F.lit("hour_start_utc"), fn.iso_text(F.col("hour_start_utc")),
        F.lit("run_type"), F.lit("hourly_hot_sync"), F.lit("http_status"), F.col("http_status").cast("string"),
        F.lit("content_sha256"), F.col("content_sha256"),
    )
    url = F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("file_name"))
    key = landing.hourly_object_key(F.col("hour_start_utc"), F.col("file_name"), F.col("content_sha256"))
    files = changed.select("body", url.alias("source_url"), metadata.alias("metadata"), key.alias("object_key"))
    land(store, "airnow_hourly_file", files, as_of)
    stage_landed(store, None, "airnow_hourly_file", as_of, regions=None)
    hour = landing.latest_completed_hour(status)
    marks = _mark(hour, PROVISIONAL, "latest_completed_hour_utc", fn.iso_text(F.col("latest_completed_hour_utc")))
    counters = run_load(store, batch_id, as_of, job=HOT_SYNC, regions=regions, issues=issues, marks=marks)
    store.discard(run)
    return counters


def gap_requests(store: ObservationStore, as_of: datetime, *, chunk_hours: int = 6, **window) -> tuple[DataFrame, DataFrame]:
    """The gap window, one row, and its chunks to fetch (ST-2, DT-13), once a bootstrap has succeeded.
    ``window``: options of :func:`~plumeline.operators.watermarks.gap_window`."""
    ledger.require_ready(ledger.run_states(store.read("runs")), "bootstrap_completed", as_of)
    marks = watermarks.latest_watermarks(store.read("watermarks"))
    tail = watermarks.authoritative_tail(marks, store.read("current"), store.read("history"))
    found = watermarks.gap_window(tail, as_of, **window)
    return found, watermarks.gap_chunks(found, chunk_hours)


def gap_fill(
    store: ObservationStore,
    batch_id: int,
    as_of: datetime,
    window: DataFrame,
    responses: DataFrame,
    *,
    regions: DataFrame | None = None,
) -> dict[str, int]:
    """Land and load the answers to gap requests (ST-2).

    ``window`` is that of :func:`gap_requests`; ``responses``: ``chunk_start_utc, chunk_end_utc, params, source_url,
    body, error`` (NULL when answered).  An empty window, failed and empty answers give
    issues; if there were requests and all failed, so does the job.
    """
    known = store.claim_batch(batch_id, GAP_FILL)
    if "counters" in known:
        return known["counters"]
    run = store.run_name(GAP_FILL, batch_id, "responses")
    got = responses.select("chunk_start_utc", "chunk_end_utc", "params", "source_url", "body", "error")
    rows = F.coalesce(F.json_array_length("body"), F.lit(0)).alias("row_count")
    got = store.once(run, "responses", got.select("*", rows))
    issues = ledger.gap_issues(window).unionByName(ledger.gap_response_issues(got))
    asked, failed = got.agg(F.count(F.lit(1)), F.count("error")).first()
    if asked and failed == asked:
        _fail(store, batch_id, GAP_FILL, as_of, issues, "gap extraction failed for all requests")
    key = landing.gap_object_key(F.col("chunk_start_utc"), F.col("chunk_end_utc"), landing.content_hash(F.col("body")))
    metadata = F.create_map(
        F.lit("run_type"), F.lit("gap_bootstrap"), F.lit("chunk_start_utc"), fn.iso_text(F.col("chunk_start_utc")),
        F.lit("chunk_end_utc"), fn.iso_text(F.col("chunk_end_utc")),
    )
    answered = got.where("error is null and row_count > 0")
    land(
        store, "airnow_gapfill_json",
        answered.select("body", "source_url", metadata.alias("metadata"), key.alias("object_key")), as_of,
    )
    stage_landed(store, None, "airnow_gapfill_json", as_of)
    counters = run_load(store, batch_id, as_of, job=GAP_FILL, regions=regions, issues=issues)
    store.discard(run)
    return counters


def reconcile_window(store: ObservationStore, as_of: datetime, **options) -> DataFrame:
    """Change dates to ask for, one row (ST-3), once the provisional feed is fresh.
    ``options``: those of :func:`~plumeline.operators.watermarks.change_window`."""
    ledger.require_ready(ledger.run_states(store.read("runs")), "recent_hourly_sync", as_of)
    return watermarks.change_window(watermarks.latest_watermarks(store.read("watermarks")), as_of, **options)


def load_authoritative(
    store: ObservationStore,
    batch_id: int,
    as_of: datetime,
    responses: DataFrame,
    *,
    window: DataFrame | None = None,
    regions: DataFrame | None = None,
) -> dict[str, int]:
    """Land and load authoritative documents: a bootstrap, or with the ``window`` of
    :func:`reconcile_window` a reconciliation, whose end becomes the checkpoint of the next.

    ``responses``: ``dataset`` (one of ``AUTHORITATIVE_DATASETS``), ``source_url, metadata, body``.
    """
    job = BOOTSTRAP if window is None else RECONCILE
    known = store.claim_batch(batch_id, job)
    if "counters" in known:
        return known["counters"]
    run = store.run_name(job, batch_id, "responses")
    got = store.once(run, "responses", responses.select("dataset", "source_url", "metadata", "body"))
    for dataset, feed in AUTHORITATIVE_DATASETS.items():
        land(store, dataset, got.where(F.col("dataset") == dataset).drop("dataset"), as_of)
        stage_landed(store, None, feed, as_of)
    marks = None
    if window is not None:
        marks = _mark(window, AUTHORITATIVE, "reconcile_last_cedate", F.date_format("end_date", "yyyyMMdd"))
    counters = run_load(store, batch_id, as_of, job=job, regions=regions, marks=marks)
    store.discard(run)
    return counters


def refresh(store: ObservationStore, snapshot: int, as_of: datetime) -> DataFrame:
    """Refresh the marts once both feeds are fresh, with entries in the run ledger (SNK-12)."""
    ledger.require_ready(ledger.run_states(store.read("runs")), "serving_upstreams", as_of)
    store.claim_batch(snapshot, REFRESH)
    record_run(store, snapshot, REFRESH, as_of, "running", "mart refresh started")
    try:
        counts = refresh_marts(store, snapshot)
        found = {r["mart"]: r["row_count"] for r in counts.collect()}  # seven rows
    except Exception as exc:
        record_run(store, snapshot, REFRESH, as_of, "failed", str(exc))
        raise
    message = " ".join(f"{name}={n}" for name, n in sorted(found.items()))
    record_run(store, snapshot, REFRESH, as_of, "success", f"Refreshed {message}")
    return counts
