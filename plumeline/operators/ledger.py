"""Run ledger, readiness and data-quality issues (SNK-10, SNK-11, TOP-4)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.ranking import first_per_key

MESSAGE_LENGTH = 2000
# Upstream job and the most hours since its last success (None: any time).
READINESS = {
    "bootstrap_completed": (("aqs_bootstrap_manual", None),),
    "recent_hourly_sync": (("airnow_hourly_hot_sync", 6),),
    "serving_upstreams": (("aqs_daily_reconcile", 30), ("airnow_hourly_hot_sync", 6)),
}


def run_states(events: DataFrame) -> DataFrame:
    """Latest state per run of an append-only event log (SNK-11).  The log keeps whole messages; this
    view of it shows their first 2000 characters.

    Runs are ranked by times and states alone, and the events at a run's last time are looked up through a hash table
    of these, so that no task sorts messages.  Only events that share a run's last time and state are sorted whole, in
    ``spark.sql.shuffle.partitions`` parts: sizes on disk, by which parts are merged otherwise, say little of long messages.
    """
    running = F.col("status") == "running"
    times = events.groupBy(F.col("run_id").alias("_run"), F.col("event_ts").alias("_ts"), running.alias("_running"))
    last = first_per_key(
        times.agg(F.count(F.lit(1)).alias("_events")), ["_run"], [F.col("_ts").desc_nulls_last(), F.col("_running").asc_nulls_last()]
    )
    at_last = F.col("run_id").eqNullSafe(F.col("_run")) & F.col("event_ts").eqNullSafe(F.col("_ts")) & running.eqNullSafe(F.col("_running"))
    shown = events.withColumn("message", F.substring("message", 1, MESSAGE_LENGTH))
    found = shown.join(last.hint("shuffle_hash"), at_last)
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = found.where(F.col("_events") > 1).repartition(parts, "run_id")
    single = found.where(F.col("_events") == 1)
    return single.unionByName(first_per_key(tied, ["run_id"], [F.col("event_ts").desc_nulls_last()])).select(*events.columns)


def latest_successes(
    runs: DataFrame, as_of: datetime | Column | None = None, within: int | None = None
) -> DataFrame:
    """Latest successful run per job, optionally no older than ``within`` hours (TOP-4, DT-14)."""
    done = runs.where(F.col("status") == "success")
    if within is not None:
        done = done.where(fn.within_hours(F.col("ended_at"), fn.as_column(as_of), within))
    return first_per_key(
        done.select("dag_id", "run_id", "ended_at"),
        ["dag_id"],
        [F.col("ended_at").desc_nulls_first(), F.col("run_id").desc()],
    )


def require_successful_run(runs: DataFrame, dag_id: str, as_of: datetime, within: int | None = None) -> str:
    """Run id of the latest success of a job, or an error."""
    found = latest_successes(runs.where(F.col("dag_id") == dag_id), as_of, within).select("run_id").first()
    if found is None:
        when = "at any time" if within is None else f"within {within} hours"
        raise RuntimeError(f"No successful run found for '{dag_id}' {when}.")
    return found[0]


def require_ready(runs: DataFrame, policy: str, as_of: datetime) -> None:
    """Check one of the :data:`READINESS` policies."""
    for dag_id, within in READINESS[policy]:
        require_successful_run(runs, dag_id, as_of, within)


def load_issues(counts: DataFrame) -> DataFrame:
    """Issues of one load from its counters: rejected and region-filtered rows (SNK-10)."""
    issue = F.array(
        F.struct(
            F.lit("normalize_payload_invalid").alias("issue_type"),
            F.col("rejected_rows").alias("n"),
            F.to_json(F.struct("rejected_rows")).alias("issue_detail"),
        ),
        F.struct(
            F.lit("airnow_region_filtered").alias("issue_type"),
            F.col("region_filtered_rows").alias("n"),
            F.to_json(F.struct(F.col("region_filtered_rows").alias("filtered_rows"))).alias("issue_detail"),
        ),
    )
    rows = counts.select(F.explode(issue).alias("i")).where(F.col("i.n") > 0)
    return rows.select("i.issue_type", F.lit(None).cast("string").alias("natural_key"), "i.issue_detail")


def gap_issues(window: DataFrame) -> DataFrame:
    """Issue recorded when a gap window holds no work (ST-2)."""
    detail = F.to_json(
        F.struct(
            fn.iso_text(F.col("aqs_tail_utc")).alias("aqs_tail_utc"),
            fn.iso_text(F.col("end_utc")).alias("end_utc"),
            fn.iso_text(F.col("start_utc")).alias("start_utc"),
        ),
        {"ignoreNullFields": "false"},
    )
    return window.where("is_empty").select(
        F.lit("airnow_gap_no_work_window").alias("issue_type"),
        F.lit(None).cast("string").alias("natural_key"),
        detail.alias("issue_detail"),
    )


def gap_response_issues(responses: DataFrame) -> DataFrame:
    """Issues of gap requests (``params``, ``error``, ``row_count``): failed or empty ones."""
    failed = F.col("error").isNotNull()
    empty = ~failed & (F.coalesce("row_count", F.lit(0)) == 0)
    return responses.where(failed | empty).select(
        F.when(failed, "airnow_gap_request_failed").otherwise("airnow_gap_empty_response").alias("issue_type"),
        F.lit(None).cast("string").alias("natural_key"),
        F.to_json(F.struct("error", "params")).alias("issue_detail"),
    )
