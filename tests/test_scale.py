"""What large tables cost: no step may sort, shuffle or write more than it has to."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumeline.catalog import fixtures as fx
from plumeline.catalog import merge_queries
from plumeline.operators import ledger, merge
from plumeline.plans.load import publish_batch
from plumeline.schemas import HISTORY, STAGED, conform
from plumeline.sources.staging import stage
from plumeline.sources.store import ObservationStore


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_run_states_ranks_without_messages(spark):
    day = lambda n: datetime(2024, 1, n)
    rows = [
        ("a", "d", day(1), "running", "x"),
        ("a", "d", day(2), "running", "y"),
        ("a", "d", day(2), "success", "z" * 3000),
        ("b", "d", None, "failed", None),
        ("c", "d", day(1), None, "n"),
        ("c", "d", day(1), "running", "x"),
        ("d", "d", day(3), "failed", "same"),
        ("d", "d", day(3), "failed", "same"),
        (None, "d", day(1), "failed", "none"),
        (None, "d", day(2), "failed", "later"),
    ]
    events = spark.createDataFrame(rows, "run_id string, dag_id string, event_ts timestamp_ntz, status string, message string")
    states = ledger.run_states(events)
    found = {r.run_id: (r.event_ts, r.status, r.message) for r in states.collect()}
    assert states.count() == 5 and states.columns == events.columns
    assert found["a"] == (day(2), "success", "z" * 2000) and found["b"] == (None, "failed", None)
    assert found["c"] == (day(1), "running", "x") and found["d"][2] == "same" and found[None][2] == "later"
    assert "ShuffledHashJoin" in _plan(states)


@pytest.mark.parametrize("name", ["staging_union_dedupe", "load_batch", "refresh_current_flags", "history_append"])
def test_queries_reading_history_repeatedly_join_the_lines_once(spark, name):
    plan = _plan(merge_queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "lines-" in plan and "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_stored_history_is_history(spark):
    stored, joined = fx.stored_history(spark, "/root/testdata/sf0.001"), fx.history(spark, "/root/testdata/sf0.001")
    assert stored.dtypes == joined.dtypes
    assert stored.exceptAll(joined).isEmpty() and joined.exceptAll(stored).isEmpty()


def _tables_with_lines_of_a_station_in_many_files(spark, folder):
    """Two stations whose lines lie in all eight files; keys that are null, repeat or match nothing."""
    day = lambda n: datetime(2024, 1, n)
    lines = [
        (order, part, station, part or 0, float(order or 0), "NAR"[(order or 0) % 3], "FO"[(order or 0) % 2], day(1 + (order or 0) % 28))
        for order in [*range(40), 39, None, 99]
        for part in (1, 2, 3, None, 9)
        for station in (1, 2, None, 9)
    ]
    tables = {
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "orders": ([*((n, day(1 + n % 28)) for n in [*range(40), 7]), (None, day(1))], "o_orderkey long, o_orderdate timestamp_ntz"),
        "part": ([(1, "PROMO"), (2, "LARGE"), (2, "PROMO"), (3, None), (None, "SMALL")], "p_partkey long, p_type string"),
        "supplier": ([(1, 3, "a"), (2, 4, "b"), (2, 4, "b"), (None, 5, "c")], "s_suppkey long, s_nationkey int, s_name string"),
        "nation": ([(3, "x"), (4, "y"), (5, "z")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(8 if name == "lineitem" else 1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_history_by_station_has_the_rows_of_history(spark, tmp_path):
    folder = _tables_with_lines_of_a_station_in_many_files(spark, tmp_path)
    for with_ingestion in (True, False):
        joined, dealt = fx.history(spark, folder, with_ingestion), fx.history(spark, folder, with_ingestion, by_station=True)
        assert dealt.dtypes == joined.dtypes and dealt.count() > 500
        assert dealt.exceptAll(joined).isEmpty() and joined.exceptAll(dealt).isEmpty()


def test_map_ranking_meets_the_rows_of_a_station_in_one_task(spark, tmp_path):
    """The ranking then shuffles one row per group, not one per group and task."""
    folder = _tables_with_lines_of_a_station_in_many_files(spark, tmp_path)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = fx.tables(spark, folder).history
        tasks = rows.select("location_id", F.spark_partition_id().alias("task")).distinct().collect()
    finally:
        spark.conf.set(key, before)
    assert len(tasks) == 2 and len({r.location_id for r in tasks}) == 2


@pytest.mark.parametrize("name", ["load_batch", "refresh_current_flags"])
def test_batches_are_shuffled_once_by_key(spark, name):
    """Each batch once, for all rankings and joins by key or by key and more."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = _plan(merge_queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set(key, before)
    assert "REPARTITION_BY_COL" in plan and "ENSURE_REQUIREMENTS" not in plan


def _shuffle_files(spark):
    local = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    return {f: f.stat().st_size for f in local.rglob("shuffle_*.data")}


def _left_beside(held, spark, most):
    """Bytes of shuffle files beside those ``held``, as soon as they are under ``most``, as they are removed in the background."""
    for _ in range(100):
        left = sum(size for f, size in _shuffle_files(spark).items() if f not in held)
        if left <= most:
            break
        time.sleep(0.1)
    return left


def test_stored_lines_leave_no_shuffle_files(spark, tmp_path):
    folder = _tables_with_lines_of_a_station_in_many_files(spark, tmp_path)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, held = spark.conf.get(key), _shuffle_files(spark)
    spark.conf.set(key, "-1")
    try:
        stored = fx.stored_history(spark, folder)
    finally:
        spark.conf.set(key, before)
    assert _left_beside(held, spark, 0) == 0 and stored.count() > 500


def test_loads_leave_neither_shuffle_files_nor_work_tables(spark, tmp_path):
    store, held = ObservationStore(spark, str(tmp_path / "store"), buckets=1), _shuffle_files(spark)
    number = F.col("id").cast("string")
    rows = spark.range(0, 20_000, 1, 4).select(
        number.alias("natural_key"), F.sha2(number, 256).alias("record_hash"), F.lit("AIRNOW").alias("source_system"),
        F.lit(10).alias("source_priority"), F.lit("hourly").alias("data_granularity"), F.lit(datetime(2024, 1, 1)).alias("timestamp_start_utc"),
    )
    assert publish_batch(store, 1, "t/1", conform(rows, HISTORY), datetime(2024, 1, 2)) == 20_000
    # some hundred bytes per partition are left by counts; whole rows come to some megabytes
    assert _left_beside(held, spark, 50_000) <= 50_000
    assert store.children(f"{store.work_dir}/t/1") == []
    assert publish_batch(store, 1, "t/1", conform(rows, HISTORY), datetime(2024, 1, 2)) == 20_000
    assert store.read("current").count() == store.read("history").count() == 20_000


_ROW = "natural_key string, record_hash string, source_system string, source_priority int, value_numeric double"


def test_upsert_keeps_keys_that_are_null_or_repeated(spark):
    current = [
        ("a", "h1", "AIRNOW", 10, 1.0), ("a", "h2", "AIRNOW", 10, 2.0), ("b", "h1", "AQS", 100, 3.0), ("c", "h1", "AQS", None, 4.0),
        (None, "h1", "AQS", 10, 5.0), (None, "h1", "AQS", 10, 5.0),
    ]
    incoming = [
        ("a", "h2", "AIRNOW", 10, None), ("b", "h9", "AIRNOW", 10, 7.0), ("c", "h8", "AQS", 100, 8.0), ("d", None, "AQS", 10, 9.0),
        (None, "h7", "AQS", 100, 10.0),
    ]
    stored = spark.createDataFrame(current, _ROW).withColumn("updated_at", F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    batch = spark.createDataFrame(incoming, _ROW).withColumns(
        {"timestamp_start_utc": F.lit(datetime(2024, 1, 1)), "source_last_modified_date": F.lit(None).cast("date")}
    )
    after = merge.upsert_current(stored, batch, datetime(2024, 1, 2))
    assert after.columns == stored.columns
    found = sorted(((*r[:5], r.updated_at.day) for r in after.collect()), key=str)
    assert found == sorted(
        [
            ("a", "h2", "AIRNOW", 10, None, 2), ("a", "h2", "AIRNOW", 10, 2.0, 1), ("b", "h1", "AQS", 100, 3.0, 1),
            ("c", "h1", "AQS", None, 4.0, 1), ("d", None, "AQS", 10, 9.0, 2), (None, "h1", "AQS", 10, 5.0, 1),
            (None, "h1", "AQS", 10, 5.0, 1), (None, "h7", "AQS", 100, 10.0, 2),
        ],
        key=str,
    )


def test_versions_with_nulls_are_never_known_nor_current(spark):
    rows = [("a", "h", "AQS"), ("a", None, "AQS"), (None, "h", "AQS"), ("b", "h", "AQS"), ("b", "h", "AQS"), ("c", "h", "AQS")]
    versions = "natural_key string, record_hash string, source_system string"
    stored = spark.createDataFrame([*rows[:3], ("c", "h", "AIRNOW")], versions)
    incoming = spark.createDataFrame(rows, versions)
    new = merge.new_history_rows(stored, incoming)
    assert sorted(map(tuple, new.collect()), key=str) == sorted(rows[1:], key=str)
    flagged = {(tuple(r)[:3], r.is_current_version) for r in merge.with_current_flags(incoming, stored).collect()}
    assert flagged == {(r, r == ("a", "h", "AQS")) for r in rows}


def test_rows_by_key_are_the_rows(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, 2, "x"), ("b", None, "y")], "natural_key string, n int, t string")
    dealt = merge.by_key(rows)
    assert dealt.columns == rows.columns
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()


_STAGED = "object_key string, source_row_hash string, record_hash string, source_dataset string"
_OLD = [("k/1", "a", "1", "airnow_hourly_file"), ("k/1", "b", "2", "airnow_hourly_file"), (None, "x", "3", "airnow_hourly_file")]
_NEW = [
    ("k/1", "b", "9", "aqs_daily"), ("k/1", "c", "5", "aqs_daily"), ("k/1", "c", "4", "aqs_daily"), ("k/2", "a", "6", "aqs_daily"),
    (None, "x", "8", "aqs_daily"), (None, "x", "7", "aqs_daily"), (None, None, "2", "aqs_daily"), ("k/3", None, "1", "aqs_daily"),
]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_staging_shuffles_only_rows_whose_keys_repeat(spark, tmp_path, monkeypatch, threshold):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    store, plans = ObservationStore(spark, str(tmp_path / "store")), []
    append = store.append
    monkeypatch.setattr(store, "append", lambda name, df: (plans.append(_plan(df)), append(name, df)))
    try:
        for rows in (_OLD, _NEW):
            stage(store, conform(spark.createDataFrame(rows, _STAGED), STAGED), datetime(2024, 1, 1))
    finally:
        spark.conf.set(key, before)
    found = store.read("staging").select("object_key", "source_row_hash", "record_hash").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [r[:3] for r in _OLD]
        + [("k/1", "c", "4"), ("k/2", "a", "6"), (None, "x", "7"), (None, None, "2"), ("k/3", None, "1")],
        key=str,
    )
    # with a threshold, the rows of keys that come once pass a broadcast of the others' hashes and no ranking
    assert all(("BroadcastHashJoin [_key" in plan and "LeftAnti" in plan) == (threshold == "10MB") for plan in plans) and len(plans) == 2
