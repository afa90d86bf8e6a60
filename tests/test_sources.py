"""File readers and normalisers on small files (SRC-1..3, NRM-1, NRM-2)."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumeline.operators.normalise import normalise_authoritative, normalise_provisional
from plumeline.sources import config
from plumeline.sources.delimited import read_hourly_files
from plumeline.sources.documents import authoritative_rows, gap_fill_rows, read_json_documents


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def maps(df):
    return [dict(r.raw_fields) for r in df.select("raw_fields").collect()]


def test_hourly_file_with_header(spark, tmp_path):
    path = write(
        tmp_path / "a.dat", "ValidDate|ValidTime|AQSID|ParameterName|Value\n2026-04-17|13|060010001|PM2.5|12.3\n"
    )
    assert maps(read_hourly_files(spark, path)) == [
        {"ValidDate": "2026-04-17", "ValidTime": "13", "AQSID": "060010001", "ParameterName": "PM2.5", "Value": "12.3"}
    ]


def test_hourly_layouts_mixed_in_one_scan(spark, tmp_path):
    write(tmp_path / "piped.dat", "\n  \n04/17/26|13:00|060010001|Site \xe9| -8|O3|ppb|12|Agency|more|still\r\n||||\r\n")
    write(
        tmp_path / "comma.dat",
        'aqsid,Value,Value,"site name"\n060010001,1,2,"Hill, the ""old"" one"\n060010002, 3\n',
    )
    write(tmp_path / "latin.dat", b"2026-04-17|13|060010009|Caf\xe9|0|PM10|ug/m3|5|X\n")
    write(tmp_path / "empty.dat", "\n \n")
    rows = {r.object_key.rsplit("/", 1)[1]: [] for r in read_hourly_files(spark, str(tmp_path)).collect()}
    for r in read_hourly_files(spark, str(tmp_path)).collect():
        rows[r.object_key.rsplit("/", 1)[1]].append(dict(r.raw_fields))
    assert set(rows) == {"piped.dat", "comma.dat", "latin.dat"}
    assert rows["piped.dat"] == [
        {
            "ValidDate": "04/17/26", "ValidTime": "13:00", "AQSID": "060010001", "SiteName": "Site \xe9", "GMTOffset": "-8",
            "ParameterName": "O3", "ReportingUnits": "ppb", "Value": "12", "DataSource": "Agency", "extra_9": "more",
            "extra_10": "still",
        }
    ]
    assert sorted(rows["comma.dat"], key=str) == sorted(
        [
            {"aqsid": "060010001", "Value": "2", "site name": 'Hill, the "old" one'},
            {"aqsid": "060010002", "Value": "3"},
        ],
        key=str,
    )
    assert rows["latin.dat"][0]["SiteName"] == "Caf�"


def test_large_file_is_split_and_keeps_its_header(spark, tmp_path):
    body = "".join(f"2026-04-17|13|06001{i % 10000:04d}|PM2.5|{i}\n" for i in range(20000))
    path = write(tmp_path / "big.dat", "ValidDate|ValidTime|AQSID|ParameterName|Value\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = read_hourly_files(spark, path)
        assert rows.rdd.getNumPartitions() > 1
        assert rows.count() == 20000
        assert rows.where(F.col("raw_fields")["Value"].isNull()).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_authoritative_documents(spark, tmp_path):
    write(tmp_path / "list.json", json.dumps([{"state_code": "01"}, 5, "x", None]))
    write(tmp_path / "data.json", json.dumps({"Header": [{"status": "ok"}], "Data": [{"state_code": "02", "poc": 1}]}))
    write(tmp_path / "body.json", json.dumps({"Data": {"no": "list"}, "body": [{"state_code": "03"}], "data": None}))
    write(tmp_path / "none.json", json.dumps({"rows": [{"state_code": "04"}]}))
    write(tmp_path / "text.json", json.dumps("hello"))
    rows = authoritative_rows(read_json_documents(spark, str(tmp_path)))
    assert sorted((r.state_code, r.poc) for r in rows.collect()) == sorted([("01", None), ("02", "1"), ("03", None)], key=str)


def daily(spark, tmp_path, *rows, **options):
    path = write(tmp_path / "d.json", json.dumps({"Data": list(rows)}))
    read = authoritative_rows(read_json_documents(spark, path))
    return normalise_authoritative(read, options.pop("dataset", "aqs_daily"), config.pollutant_config(spark), **options)


BASE = {"parameter_code": "44201", "state_code": "6", "county_code": "1", "site_number": "1", "date_local": "2026-04-17"}


def test_zero_falls_through_only_as_a_number(spark, tmp_path):
    cases = [
        ({"arithmetic_mean": 0, "first_max_value": 0.0, "aqi": 7}, 7.0),
        ({"arithmetic_mean": 0, "first_max_value": None, "aqi": 0}, 0.0),
        ({"arithmetic_mean": "0", "first_max_value": 9}, 0.0),
        ({"arithmetic_mean": "", "first_max_value": 9}, 9.0),
        ({"arithmetic_mean": "bad", "first_max_value": 9}, None),
        ({"arithmetic_mean": 0}, None),
        ({"arithmetic_mean": -1.5}, -1.5),
    ]
    for i, (fields, expected) in enumerate(cases):
        got = [r.value_numeric for r in daily(spark, tmp_path / str(i), {**BASE, **fields}).collect()]
        assert got == ([] if expected is None else [expected]), fields


def test_authoritative_daily_record(spark, tmp_path):
    row = {**BASE, "arithmetic_mean": 0.04, "poc": 2, "date_of_last_change": "2026-05-01", "method_code": " 047 ", "qualifier": ""}
    got = daily(spark, tmp_path, row).first()
    assert got.location_id == "aqs:06:001:0001:2"
    assert got.site_natural_location_id == "aqs_site:06:001:0001"
    assert got.natural_key == "aqs_site:06:001:0001|44201|concentration|daily|2026-04-17T00:00:00+00:00"
    assert (got.unit, got.source_priority, got.data_status, got.source_system) == ("ppm", 100, "final", "AQS")
    assert got.timestamp_end_utc == datetime(2026, 4, 18) and got.timestamp_local == datetime(2026, 4, 17)
    assert str(got.source_last_modified_date) == "2026-05-01"
    assert (got.method_code, got.qualifier_raw, got.aqsid) == ("047", None, "060010001")


def test_authoritative_blanks_and_null_text(spark, tmp_path):
    row = {**BASE, "state_code": "", "site_number": None, "arithmetic_mean": 1, "method_code": None, "poc": None}
    got = daily(spark, tmp_path, row).first()
    assert got.location_id == "aqs:na:001:00na:na" and got.method_code is None
    compat = daily(spark, tmp_path, row, compat_none_text=True).first()
    assert compat.location_id == "aqs:na:001:00na:None" and compat.method_code == "None"


def test_authoritative_sample_times(spark, tmp_path):
    rows = [
        {**BASE, "sample_measurement": 0, "date_gmt": "2026-04-17", "time_gmt": "20:00", "time_local": "13:00"},
        {**BASE, "sample_measurement": 5, "date_gmt": "bad", "date_local": "20260417"},
        {**BASE, "sample_measurement": 5, "date_local": "never"},
        {**BASE, "sample_measurement": None},
        {**BASE, "parameter_code": " ", "param": "44201", "sample_measurement": 5},
    ]
    got = daily(spark, tmp_path, *rows, dataset="aqs_sample").orderBy("value_numeric").collect()
    assert [(r.value_numeric, r.timestamp_start_utc, r.timestamp_local, r.timestamp_end_utc) for r in got] == [
        (0.0, datetime(2026, 4, 17, 20), datetime(2026, 4, 17, 13), None),
        (5.0, datetime(2026, 4, 17), datetime(2026, 4, 17), None),
    ]


@pytest.fixture
def provisional(spark, tmp_path):
    def run(*rows, regions=None, **kw):
        path = write(tmp_path / "gap.json", json.dumps(list(rows)))
        read = gap_fill_rows(read_json_documents(spark, path))
        return normalise_provisional(read, "airnow_gapfill_json", config.pollutant_aliases(spark), regions, **kw)

    return run


PROV = {"ParameterName": "PM2.5", "Value": "12.3", "ValidDate": "2026-04-17", "ValidTime": "13", "GMTOffset": "-7"}


def test_provisional_region_filter(spark, provisional):
    rows = [{**PROV, "AQSID": "06-001-0001"}, {**PROV, "AQSID": "12-001-0001"}]
    states = config.region_config(spark, [{"id": "ca", "state_codes": ["6"]}])
    assert [r.aqsid for r in provisional(*rows, regions=states).collect()] == ["060010001"]
    pairs = config.region_config(spark, [{"id": "p", "state_county_pairs": [{"state_code": "12", "county_code": "1"}]}])
    assert [r.aqsid for r in provisional(*rows, regions=pairs).collect()] == ["120010001"]
    nothing = config.region_config(spark, [{"id": "none"}])
    assert provisional(*rows, regions=nothing).count() == 2
    assert provisional(*rows).count() == 2


def test_provisional_record(provisional):
    got = provisional({**PROV, "FullAQSCode": "840060010001", "Agency": "x", "AgencyName": " CARB "}).first()
    assert got.location_id == "airnow:060010001"
    assert got.natural_key == "aqs_site:06:001:0001|88101|concentration|hourly|2026-04-17T20:00:00+00:00"
    assert got.timestamp_local == datetime(2026, 4, 17, 13) and got.timestamp_end_utc == datetime(2026, 4, 17, 21)
    assert (got.unit, got.qualifier_raw, got.source_priority, got.data_status) == ("unknown", "CARB", 10, "provisional")


def test_provisional_utc_wins_and_bad_rows_drop(provisional):
    rows = [
        {"Parameter": "ozone", "Value": 0, "AQSID": "060010001", "UTC": "2026-04-17T20:00", "Unit": "PPB"},
        {**PROV, "AQSID": "060010001", "Value": "n/a"},
        {**PROV, "AQSID": "6001"},
        {**PROV, "AQSID": "060010001", "ParameterName": "noise"},
        {**PROV, "AQSID": "060010001", "ValidTime": "24"},
    ]
    got = provisional(*rows).collect()
    assert [(r.pollutant_code, r.value_numeric, r.unit) for r in got] == [("44201", 0.0, "PPB")]
    assert got[0].timestamp_local == got[0].timestamp_start_utc == datetime(2026, 4, 17, 20)


def test_region_selection(spark):
    assert config.region_config(spark, region_ids=["us_ny_metro"]).collect()[0].state_code == "34"
    with pytest.raises(ValueError):
        config.region_config(spark, region_ids=["nowhere"])


def test_alias_table_covers_names_and_short_names(spark):
    keys = {r.alias_key: r.pollutant_code for r in config.pollutant_aliases(spark).collect()}
    assert keys["pm2.5localconditions"] == "88101" and keys["co"] == "42101" and keys["ozone"] == "44201"
    assert len(keys) == 13  # six names and eleven aliases, four of them in both
