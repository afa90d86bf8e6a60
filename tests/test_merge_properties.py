"""Properties of merging and validation, also under a hot key."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumeline.catalog import fixtures as fx
from plumeline.operators import ledger, marts, merge, validate, watermarks
from plumeline.plans.serving import map_kpis
from plumeline.sources import config

T0 = datetime(2026, 1, 1)
SCHEMA = (
    "natural_key string, record_hash string, source_system string, source_priority int, value_numeric double, "
    "timestamp_start_utc timestamp, source_last_modified_date date, ingested_at timestamp"
)


def rows(n, seed):
    """Random versions; a third of them share one key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(n // 4)}"
        final = rng.random() < 0.3
        changed = None if rng.random() < 0.3 else (T0 + timedelta(days=rng.randrange(5))).date()
        out.append(
            (
                key, f"{seed}-{i:05d}", "AQS" if final else "AIRNOW", 100 if final else 10, float(rng.randrange(100)),
                T0 + timedelta(hours=rng.randrange(3)), changed, T0 + timedelta(minutes=rng.randrange(50)),
            )
        )
    return out


@pytest.fixture(scope="module")
def batches(spark):
    return [rows(900, seed) for seed in (1, 2)]


def winner(versions):
    lowest = datetime.min.date()
    return max(versions, key=lambda r: (r[3], r[5], r[6] is not None, r[6] or lowest, r[1]))


def test_merge_matches_brute_force_with_a_hot_key(spark, batches):
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    current = merge.rebuild_current(frames[0], T0)
    expected = {}
    for r in batches[0]:
        best = expected.get(r[0])
        if best is None or (r[3], r[7], r[1]) > (best[3], best[7], best[1]):
            expected[r[0]] = r
    assert {r.natural_key: r.record_hash for r in current.collect()} == {k: v[1] for k, v in expected.items()}

    by_key = {}
    for r in batches[1]:
        by_key.setdefault(r[0], []).append(r)
    audit = sorted(
        (k, expected[k][1], r[1])
        for k, versions in by_key.items()
        for r in versions
        if k in expected and expected[k][2] == r[2] == "AIRNOW" and expected[k][1] != r[1]
    )
    got = merge.revision_audit(current, frames[1]).collect()
    assert sorted((r.natural_key, r.old_hash, r.new_hash) for r in got) == audit

    for k, versions in by_key.items():
        best = winner(versions)
        old = expected.get(k)
        if old is None or best[3] > old[3] or (best[3] == old[3] and best[1] != old[1]):
            expected[k] = best
    merged = merge.upsert_current(current, frames[1], T0 + timedelta(days=1))
    assert {r.natural_key: r.record_hash for r in merged.collect()} == {k: v[1] for k, v in expected.items()}

    again = merge.upsert_current(merged, frames[1], T0 + timedelta(days=2))
    assert sorted(again.collect()) == sorted(merged.collect())  # idempotent, updated_at included


def test_at_most_one_current_version_per_key(spark, batches):
    history = spark.createDataFrame(batches[0] + batches[1], SCHEMA)
    flagged = merge.with_current_flags(history, merge.rebuild_current(history, T0))
    counts = flagged.groupBy("natural_key").agg(F.count_if("is_current_version").alias("n"))
    assert {r.n for r in counts.collect()} == {1}
    assert merge.new_history_rows(history, history).count() == 0


def test_statuses_partition_the_input(spark):
    sf = "/root/testdata/sf0.001"
    staged = fx.history(spark, sf).withColumn("aqsid", F.lit("060010001"))
    counts = validate.status_counts(validate.validated(staged, config.region_config(spark))).first()
    assert sum(counts) == staged.count()


def test_validation_example(spark):
    base = {
        "natural_key": "k", "location_id": "airnow:060010001", "pollutant_code": "88101", "metric_type": "concentration",
        "value_numeric": "12.3", "unit": "ug/m3", "data_granularity": "hourly",
        "timestamp_start_utc": "2026-04-17T20:00:00+00:00", "source_system": "AIRNOW", "source_dataset": "airnow_hourly_file",
        "source_priority": "10", "data_status": "provisional", "record_hash": "h", "aqsid": "060010001",
    }
    cases = [
        (base, "valid"),
        ({**base, "aqsid": "120010001"}, "region_filtered"),
        ({**base, "aqsid": "12"}, "region_filtered"),
        ({**base, "aqsid": "120010001", "source_system": "AQS", "data_status": "final"}, "valid"),
        ({**base, "value_numeric": "0"}, "valid"),
        ({**base, "unit": ""}, "rejected"),
        ({**base, "record_hash": None}, "rejected"),
        ({**base, "timestamp_start_utc": "soon"}, "rejected"),
        ({**base, "data_status": "draft"}, "rejected"),
    ]
    names = list(base)
    df = spark.createDataFrame(
        [(i, *[case[n] for n in names]) for i, (case, _) in enumerate(cases)],
        "i int, " + ", ".join(f"{n} string" for n in names),
    )
    regions = config.region_config(spark, [{"id": "ca", "state_codes": ["06"]}])
    got = [r.status for r in validate.validated(df, regions).orderBy("i").collect()]
    assert got == [expected for _, expected in cases]


def test_thresholds_fan_out_in_the_latest_mart_only(spark):
    fact = spark.createDataFrame(
        [("k", "l", "p", "concentration", 5.0, "u", "daily", T0, T0, "AQS", "d", "final", T0)],
        "natural_key string, location_id string, pollutant_code string, metric_type string, value_numeric double, unit string, "
        "data_granularity string, timestamp_start_utc timestamp, timestamp_local timestamp, source_system string, "
        "source_dataset string, data_status string, updated_at timestamp",
    )
    location = spark.createDataFrame(
        [("l", "site", "US", "06", "001", "0001", "x", "n", "c", 1.0, 2.0)],
        "location_id string, location_type string, country_code string, state_code string, county_code string, "
        "site_number string, aqsid string, site_name string, city_name string, latitude double, longitude double",
    )
    pollutant = spark.createDataFrame([("p", "name")], "pollutant_code string, pollutant_name string")
    threshold = spark.createDataFrame(
        [("p", "a", 3.0, "u", True), ("p", "b", 9.0, "u", True), ("p", "c", 0.0, "u", False)],
        "pollutant_code string, threshold_type string, threshold_value double, unit string, is_active boolean",
    )
    latest = marts.latest_station(fact, location, pollutant, threshold)
    assert sorted((r.threshold_type, r.is_exceedance) for r in latest.collect()) == [("a", True), ("b", False)]
    events = marts.exceedance_events(fact, location, pollutant, threshold).collect()
    assert [(r.threshold_type, r.exceedance_margin) for r in events] == [("a", 2.0)]
    assert map_kpis(latest).first().exceedance_points == 1


def test_gap_and_change_windows(spark):
    tail = spark.createDataFrame([(datetime(2026, 1, 1, 10, 30),)], "tail timestamp")
    now = datetime(2026, 1, 1, 15, 45)
    w = watermarks.gap_window(tail, now).first()
    assert (w.start_utc, w.end_utc, w.is_empty) == (datetime(2026, 1, 1, 11), datetime(2026, 1, 1, 14), False)
    none = spark.createDataFrame([(None,)], "tail timestamp")
    assert watermarks.gap_window(none, now).first().start_utc == datetime(2026, 1, 1, 9)
    late = watermarks.gap_window(tail, datetime(2026, 1, 1, 11))
    assert late.first().is_empty and ledger.gap_issues(late).first().issue_type == "airnow_gap_no_work_window"
    manual = watermarks.gap_window(tail, now, manual_start=T0, manual_end=now).first()
    assert (manual.start_utc, manual.aqs_tail_utc) == (T0, None)

    schema = "source_name string, watermark_key string, watermark_value string, updated_at timestamp"
    marks = spark.createDataFrame([("AQS", "reconcile_last_cedate", "20251220", T0)], schema)
    assert str(watermarks.change_window(marks, now).first().start_date) == "2025-12-19"
    assert str(watermarks.change_window(marks.limit(0), now).first().start_date) == "2025-12-30"
    manual = watermarks.change_window(marks, now, manual_start="20250101", manual_end="20250131").first()
    assert str(manual.end_date) == "2025-01-31"


def test_readiness(spark):
    runs = spark.createDataFrame(
        [("1", "airnow_hourly_hot_sync", "success", T0), ("2", "aqs_daily_reconcile", "failed", T0)],
        "run_id string, dag_id string, status string, ended_at timestamp",
    )
    ledger.require_ready(runs, "recent_hourly_sync", T0 + timedelta(hours=6))
    with pytest.raises(RuntimeError):
        ledger.require_ready(runs, "recent_hourly_sync", T0 + timedelta(hours=7))
    with pytest.raises(RuntimeError):
        ledger.require_ready(runs, "serving_upstreams", T0)
