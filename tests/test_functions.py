"""Row-level expressions on hand-made values (NRM, DT, VAL-1)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumeline import functions as fn


def evaluate(spark, expression, *values):
    """Values of an expression over a text column ``c``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_zero_fill_code(spark):
    got = evaluate(spark, lambda c: fn.zero_fill_code(c, 4), "7", "", None, " 12345 ", "na")
    assert got == ["0007", "00na", "00na", "12345", "00na"]


def test_first_non_blank(spark):
    df = spark.createDataFrame([(" ", None, " x "), ("a", "b", "c"), (None, "\t", "")], "p string, q string, r string")
    assert [r[0] for r in df.select(fn.first_non_blank(F.col("p"), F.col("q"), F.col("r"))).collect()] == ["x", "a", None]


def test_parse_number(spark):
    got = evaluate(
        spark, fn.parse_number, "12.3", " -4 ", "1e2", ".5", "5.", "1.5d", "1e2f", "nan", "inf", "1e400", "n/a", "", None, "0", "1e300", "1e-305", "-1e999"
    )
    assert got == [12.3, -4.0, 100.0, 0.5, 5.0, None, None, None, None, None, None, None, None, 0.0, 1e300, 1e-305, None]


def test_first_nonzero(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 3.0), (0.0, None, 0.0), (None, 2.0, 1.0), (0.0, 0.0, None)], "a double, b double, c double"
    )
    got = [r[0] for r in df.select(fn.first_nonzero(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [3.0, 0.0, 2.0, None]


def test_site_ids(spark):
    got = evaluate(spark, fn.normalize_site_id, "06-001-0001", "840060010001", "06001000", "1840060010001", None)
    assert got == ["060010001", "060010001", None, "060010001", None]
    got = evaluate(
        spark, lambda c: fn.site_location_id(site_id=c, fallback=F.concat(F.lit("airnow:"), c)), "060010001", "12", None
    )
    assert got == ["aqs_site:06:001:0001", "airnow:12", "unknown_location"]
    by_code = fn.site_location_id(
        state_code=F.lit("6"), county_code=F.lit(" 1 "), site_number=F.col("c"), fallback=F.lit("x")
    )
    assert evaluate(spark, lambda c: by_code, "1", "") == ["aqs_site:06:001:0001", "x"]


def test_pollutant_key(spark):
    assert evaluate(spark, fn.pollutant_key, " PM2.5 - Local ", "O3", None) == ["pm2.5local", "o3", ""]


def test_null_if_na(spark):
    assert evaluate(spark, fn.null_if_na, " NA ", "0na", "", "06", None) == [None, "0na", None, "06", None]


def test_date_time_pair(spark):
    df = spark.createDataFrame(
        [("2026-04-17", "13:45"), ("invalid", "13:45"), ("2026-4-7", " "), ("2026-04-17", "24:00"), ("2026-04-17", "13")],
        "d string, t string",
    )
    got = [r[0] for r in df.select(fn.parse_date_time(F.col("d"), F.col("t"))).collect()]
    assert got == [datetime(2026, 4, 17, 13, 45), None, datetime(2026, 4, 7), None, None]


def test_dates(spark):
    got = evaluate(spark, fn.parse_iso_date, "2026-4-7", "20260417", "2026/04/17", "2026-13-01", "2026", "")
    assert got == [date(2026, 4, 7), date(2026, 4, 17), None, None, None, None]
    got = evaluate(
        spark, fn.parse_feed_date, "2026-04-17", "2026/4/7", "4/7/26", "04/17/2026", "1/2/69", "1/2/68", "20260417", "4/31/26"
    )
    assert got == [
        date(2026, 4, 17), date(2026, 4, 7), date(2026, 4, 7), date(2026, 4, 17), date(1969, 1, 2), date(2068, 1, 2), None, None,
    ]


def test_utc_timestamps(spark):
    values = {
        "2026-04-17T13:00Z": datetime(2026, 4, 17, 13),
        "2026-04-17T13:00:00-07:00": datetime(2026, 4, 17, 20),
        "2026-04-17 13:00:00.25": datetime(2026, 4, 17, 13, 0, 0, 250000),
        "2026-04-17T13": datetime(2026, 4, 17, 13),
        "2026-04-17T13+0530": datetime(2026, 4, 17, 7, 30),
        "2026-04-17": datetime(2026, 4, 17),
        "2026-4-7 3:5": datetime(2026, 4, 7, 3, 5),
        "2026-4-7": None,
        "2026": None,
        "soon": None,
        "2026-04-17T25:00": None,
        "": None,
    }
    assert evaluate(spark, fn.parse_utc_timestamp, *values) == list(values.values())


def test_hours(spark):
    got = evaluate(spark, fn.parse_hour, "13", "13:45", "7.9", "24", "-0.5", "-1", "x", "", "1e1")
    assert got == [13, 13, 7, None, 0, None, None, None, 10]


def test_offsets(spark):
    def shift(c):
        local = fn.local_timestamp(F.lit("2026-04-17"), F.lit("13:00"))
        return fn.local_to_utc(local, fn.parse_offset_hours(c))

    assert evaluate(spark, shift, "-7", "5.5", None, "bad") == [
        datetime(2026, 4, 17, 20), datetime(2026, 4, 17, 7, 30), datetime(2026, 4, 17, 13), datetime(2026, 4, 17, 13),
    ]
    # far offsets count as long as they lead to an instant of the years 1 to 9999
    assert evaluate(spark, shift, "-60000000", "17000000", "1e8", "-1e300") == [
        datetime(2026, 4, 17, 13) + timedelta(hours=60_000_000), datetime(2026, 4, 17, 13) - timedelta(hours=17_000_000), None, None,
    ]


def test_iso_text(spark):
    df = spark.createDataFrame([(datetime(2026, 4, 17, 13),), (datetime(2026, 4, 17, 13, 0, 0, 5),)], "t timestamp")
    expected = ["2026-04-17T13:00:00+00:00", "2026-04-17T13:00:00.000005+00:00"]
    assert [r[0] for r in df.select(fn.iso_text(F.col("t"))).collect()] == expected
    as_ntz = df.select(fn.iso_text(F.col("t").cast("timestamp_ntz")))
    assert [r[0] for r in as_ntz.collect()] == expected


def test_record_hash_is_sha256_of_sorted_compact_json(spark):
    import hashlib
    import json

    record = {"natural_key": "k", "value_numeric": 12.3, "unit": None}
    expected = hashlib.sha256(json.dumps(record, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    got = spark.range(1).select(
        fn.record_hash(natural_key=F.lit("k"), value_numeric=F.lit(12.3), unit=F.lit(None).cast("string"))
    )
    assert got.first()[0] == expected


def test_lineage_hash_ignores_map_order(spark):
    df = spark.sql("select map('a','1','b','2') m, map('b','2','a','1') n")
    row = df.select(
        *[fn.row_lineage_hash(F.lit("o"), F.lit("d"), F.col(c)) for c in ("m", "n")]
    ).first()
    assert row[0] == row[1]


def test_month_and_year_windows(spark):
    from plumeline.operators.windows import months_between, years_between

    ranges = spark.createDataFrame(
        [("a", date(2026, 1, 1), date(2026, 4, 19)), ("b", date(2025, 12, 30), date(2026, 1, 2)), ("c", date(2026, 2, 1), date(2026, 1, 1))],
        "id string, start_date date, end_date date",
    )
    months = [(r.id, r.bdate, r.edate) for r in months_between(ranges).orderBy("id", "bdate").collect()]
    assert months == [
        ("a", "20260101", "20260131"), ("a", "20260201", "20260228"), ("a", "20260301", "20260331"),
        ("a", "20260401", "20260419"), ("b", "20251230", "20251231"), ("b", "20260101", "20260102"),
    ]
    years = [(r.id, r.year, r.bdate, r.edate) for r in years_between(ranges).orderBy("id", "bdate").collect()]
    assert years == [
        ("a", "2026", "20260101", "20260419"), ("b", "2025", "20251230", "20251231"), ("b", "2026", "20260101", "20260102"),
    ]


def test_hour_chunks_and_recent_hours(spark):
    from plumeline.operators.landing import expected_hours
    from plumeline.operators.watermarks import gap_chunks

    window = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 13))], "start_utc timestamp, end_utc timestamp"
    )
    chunks = [(r[0].hour, r[1].hour) for r in gap_chunks(window, 6).orderBy("chunk_start_utc").collect()]
    assert chunks == [(0, 5), (6, 11), (12, 13)]
    empty = window.select(F.col("end_utc").alias("start_utc"), F.col("start_utc").alias("end_utc"))
    assert gap_chunks(empty).count() == 0
    hours = [r[0] for r in expected_hours(spark, datetime(2026, 1, 3, 5, 30)).orderBy("hour_start_utc").collect()]
    assert len(hours) == 48 and hours[0] == datetime(2026, 1, 1, 5) and hours[-1] == datetime(2026, 1, 3, 4)


@pytest.mark.parametrize("value,expected", [("", False), (None, False), ("0", True), ("x", True)])
def test_all_present(spark, value, expected):
    df = spark.createDataFrame([(value, 0.0)], "c string, d double")
    assert df.select(fn.all_present(F.col("c"), F.col("d"))).first()[0] is expected
