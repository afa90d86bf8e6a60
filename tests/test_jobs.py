"""The jobs around a load: landing, issues, watermarks, readiness."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumeline.operators import ledger, watermarks
from plumeline.plans import jobs, load
from plumeline.sources import config
from plumeline.sources.store import ObservationStore

NOW = datetime(2026, 5, 2, 9, 30)
HEADER = "ValidDate|ValidTime|AQSID|ParameterName|ReportingUnits|Value|GMTOffset"
LISTING = "file_name string, http_status int, body string"
RESPONSES = "chunk_start_utc timestamp, chunk_end_utc timestamp, params string, source_url string, body string, error string"


@pytest.fixture
def store(spark, tmp_path):
    return ObservationStore(spark, str(tmp_path / "store"))


@pytest.fixture
def regions(spark):
    return config.region_config(spark)


def hour_file(hour, value, site="060010007"):
    return f"{HEADER}\r\n{hour:%Y-%m-%d}|{hour.hour}|{site}|OZONE|ppm|{value}|0\r\n"


def name(hour):
    return f"HourlyData_{hour:%Y%m%d%H}.dat"


def issues_of(store, batch):
    rows = store.read("issues").where(F.col("batch_id") == batch).collect()
    return sorted((r.issue_type, json.loads(r.issue_detail).get("file_name")) for r in rows)


def marks_of(store):
    return {(r.source_name, r.watermark_key): r.watermark_value for r in watermarks.latest_watermarks(store.read("watermarks")).collect()}


def documents(spark, day, value):
    row = {
        "parameter_code": "44201", "state_code": "06", "county_code": "001", "site_number": "0007", "poc": 1,
        "date_local": day, "arithmetic_mean": value, "units_of_measure": "ppm", "date_of_last_change": "2026-05-01",
    }
    schema = "dataset string, source_url string, metadata map<string,string>, body string"
    return config.local_rows(spark, [("aqs_daily_json", "u", {"state": "06"}, json.dumps({"Data": [row]}))], schema)


def test_hot_sync_lands_changes_and_reports_the_rest(spark, store, regions):
    at = [datetime(2026, 5, 2, 9) - timedelta(hours=k) for k in range(1, 7)]  # newest first
    listing = [
        (name(at[0]), None, None), (name(at[1]), 404, None), (name(at[2]), 503, "x"), (name(at[3]), 200, ""),
        (name(at[4]), 200, hour_file(at[4], 0.04)),
    ]
    out = jobs.hot_sync(store, 1, NOW, config.local_rows(spark, listing, LISTING), hours=6, base_url="http://h/", regions=regions)
    assert out["valid_rows"] == out["inserted_history"] == 1
    assert issues_of(store, 1) == [
        ("airnow_hourly_empty_file", name(at[3])), ("airnow_hourly_http_error", name(at[2])),
        ("airnow_hourly_missing_file", name(at[1])), ("airnow_hourly_request_failed", name(at[5])),
        ("airnow_hourly_request_failed", name(at[0])),
    ]
    landed = store.read("manifest").collect()
    assert [(r.dataset, r.metadata["file_name"], r.source_url) for r in landed] == [("airnow_hourly_file", name(at[4]), f"http://h/{name(at[4])}")]
    assert landed[0].object_key.startswith("airnow/hourly/year=2026/month=05/day=02/HourlyData_2026050204_")
    assert marks_of(store)["AIRNOW", "latest_completed_hour_utc"] == "2026-05-02T04:00:00+00:00"
    # once more: the same file is no update, a revised one is a new version
    revised = [(name(at[4]), 200, hour_file(at[4], 0.04)), (name(at[3]), 200, hour_file(at[3], 0.05))]
    later = NOW + timedelta(minutes=10)
    jobs.hot_sync(store, 2, later, config.local_rows(spark, revised, LISTING), hours=6, regions=regions)
    assert ("airnow_hourly_no_update", name(at[4])) in issues_of(store, 2)
    assert store.read("objects").count() == 2 and store.read("history").count() == 2
    # the same batch again changes nothing
    before = issues_of(store, 2)
    jobs.hot_sync(store, 2, later, config.local_rows(spark, revised, LISTING), hours=6, regions=regions)
    assert issues_of(store, 2) == before and store.read("manifest").count() == 2


def test_hot_sync_fails_when_every_request_did(spark, store):
    with pytest.raises(RuntimeError, match="all files"):
        jobs.hot_sync(store, 1, NOW, config.local_rows(spark, [], LISTING), hours=2)
    assert [t for t, _ in issues_of(store, 1)] == ["airnow_hourly_request_failed"] * 2
    assert ledger.run_states(store.read("runs")).first().status == "failed"


def test_a_failed_job_goes_on_with_its_first_status(spark, store, regions, monkeypatch):
    hour = datetime(2026, 5, 2, 8)
    listing = config.local_rows(spark, [(name(hour), 200, hour_file(hour, 0.04))], LISTING)

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "run_load", lost)
        with pytest.raises(OSError):
            jobs.hot_sync(store, 1, NOW, listing, hours=1, regions=regions)
    out = jobs.hot_sync(store, 1, NOW, listing, hours=1, regions=regions)
    assert out["inserted_history"] == 1 and issues_of(store, 1) == []
    assert store.read("objects").count() == store.read("staging").count() == 1


def test_bootstrap_gap_fill_and_reconcile(spark, store, regions):
    with pytest.raises(RuntimeError, match="No successful run"):
        jobs.gap_requests(store, NOW)
    out = jobs.load_authoritative(store, 1, NOW, documents(spark, "2026-05-02", 0.03), regions=regions)
    assert out["inserted_history"] == 1
    assert store.read("manifest").first().metadata["state"] == "06"

    window, chunks = jobs.gap_requests(store, NOW, chunk_hours=3)
    asked = [(r.chunk_start_utc.hour, r.chunk_end_utc.hour) for r in chunks.orderBy("chunk_start_utc").collect()]
    assert asked == [(1, 3), (4, 6), (7, 8)]
    hours = [(datetime(2026, 5, 2, a), datetime(2026, 5, 2, b)) for a, b in asked]
    body = json.dumps([{"AQSID": "060010009", "Parameter": "OZONE", "Value": "0.02", "UTC": "2026-05-02T02:00", "Unit": "ppm"}])
    answers = [(*hours[0], "p0", "u0", body, None), (*hours[1], "p1", "u1", "[]", None), (*hours[2], "p2", "u2", None, "timeout")]
    out = jobs.gap_fill(store, 2, NOW, window, config.local_rows(spark, answers, RESPONSES), regions=regions)
    assert out["inserted_history"] == 1
    assert [t for t, _ in issues_of(store, 2)] == ["airnow_gap_empty_response", "airnow_gap_request_failed"]
    key = store.read("manifest").where("dataset = 'airnow_gapfill_json'").first().object_key
    assert key.startswith("airnow/gapfill/year=2026/month=05/day=02/gap_20260502T01_20260502T03_")

    early, nothing = jobs.gap_requests(store, NOW - timedelta(days=3))
    assert nothing.isEmpty()
    jobs.gap_fill(store, 3, NOW, early, config.local_rows(spark, [], RESPONSES), regions=regions)
    assert [t for t, _ in issues_of(store, 3)] == ["airnow_gap_no_work_window"]

    with pytest.raises(RuntimeError, match="airnow_hourly_hot_sync"):
        jobs.reconcile_window(store, NOW)
    hour = datetime(2026, 5, 2, 8)
    listing = config.local_rows(spark, [(name(hour), 200, hour_file(hour, 0.04, "120010001") + "2026-05-02|8|060010007||ppm|1|0\n")], LISTING)
    jobs.hot_sync(store, 4, NOW, listing, hours=1, regions=regions)
    assert ("airnow_region_filtered", None) in issues_of(store, 4)
    changes = jobs.reconcile_window(store, NOW)
    assert [str(d) for d in changes.first()] == ["2026-04-30", "2026-05-02"]
    jobs.load_authoritative(store, 5, NOW, documents(spark, "2026-05-02", 0.05), window=changes, regions=regions)
    assert marks_of(store)["AQS", "reconcile_last_cedate"] == "20260502"
    assert [str(d) for d in jobs.reconcile_window(store, NOW + timedelta(hours=3)).first()] == ["2026-05-01", "2026-05-02"]

    counts = {r.mart: r.row_count for r in jobs.refresh(store, 6, NOW).collect()}
    assert counts["latest_station"] == 1
    states = {r.run_id: (r.status, r.message) for r in ledger.run_states(store.read("runs")).collect()}
    assert states["serving_rollups_daily:6"][0] == "success" and "latest_station=1" in states["serving_rollups_daily:6"][1]


def test_landing_keeps_one_object_a_key(spark, store):
    schema = "body string, source_url string, metadata map<string,string>"
    rows = config.local_rows(spark, [("[1]", "a", None), ("[1]", "b", None), (None, "c", None), ("", "d", None)], schema)
    for hour in (1, 1, 2):
        load.land(store, "aqs_metadata_json", rows, datetime(2026, 5, 1, hour))
    assert store.read("objects").count() == 4  # two texts, two landing times
    assert {r.body for r in store.read("objects").collect()} == {"[1]", ""}
    from plumeline.operators.landing import current_manifest

    assert current_manifest(store.read("manifest")).count() == 4
