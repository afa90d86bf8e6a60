"""Marts and serving queries over the sample tables, each with its SQL oracle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.catalog import fixtures as fx
from plumeline.catalog.fixtures import with_views
from plumeline.operators import marts
from plumeline.plans import serving

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_date(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in columns})


# --- marts -------------------------------------------------------------------

# The oracles take other routes than the marts: maxima of composite values in place of
# rankings, dimensions looked up after grouping, frames as joins on row numbers.
_LATEST = """
newest_time AS (
  SELECT location_id, pollutant_code, max({'at': timestamp_start_utc, 'changed': updated_at}) AS top
  FROM cur WHERE data_granularity = 'daily' GROUP BY location_id, pollutant_code),
newest AS (
  SELECT arg_min(c, c.natural_key) AS fact
  FROM cur c JOIN newest_time n ON c.location_id = n.location_id AND c.pollutant_code = n.pollutant_code
  WHERE c.data_granularity = 'daily' AND {'at': c.timestamp_start_utc, 'changed': c.updated_at} = n.top
  GROUP BY c.location_id, c.pollutant_code),
limits AS (SELECT pollutant_code, unit, threshold_type, threshold_value FROM threshold WHERE is_active)
"""
_LATEST_SELECT = """
SELECT fact.natural_key, fact.location_id, place.location_type, place.country_code, place.state_code, place.county_code,
       place.site_number, place.aqsid, place.site_name, place.city_name, place.latitude, place.longitude,
       fact.pollutant_code, name.pollutant_name, fact.metric_type, fact.value_numeric, fact.unit, fact.data_granularity,
       fact.timestamp_start_utc, fact.timestamp_local, fact.source_system, fact.source_dataset, fact.data_status,
       limits.threshold_type, limits.threshold_value, fact.value_numeric > limits.threshold_value AS is_exceedance
FROM newest
LEFT JOIN limits ON limits.pollutant_code = fact.pollutant_code AND limits.unit = fact.unit,
     location place, pollutant name
WHERE place.location_id = fact.location_id AND name.pollutant_code = fact.pollutant_code
"""


@register("latest_station", with_views("cur location pollutant threshold", f", {_LATEST} {_LATEST_SELECT}"))
def _latest_station(spark, sf):
    t = fx.tables(spark, sf, with_ingestion=True)
    return marts.latest_station(t.current, t.location, t.pollutant, t.threshold)


_TREND = """
SELECT state_code, county_code, location_id, pollutant_code, pollutant_name, {names},
       round(total / observation_count, 6) AS avg_value, min_value, max_value, observation_count{extra}
FROM (
  SELECT location_id, pollutant_code, {periods}, sum(value_numeric) AS total, min(value_numeric) AS min_value,
         max(value_numeric) AS max_value, count(*) AS observation_count,
         count(CASE data_status WHEN 'final' THEN 1 END) AS final_count,
         count(CASE data_status WHEN 'provisional' THEN 1 END) AS provisional_count
  FROM cur WHERE data_granularity = 'daily' GROUP BY ALL)
NATURAL JOIN (SELECT location_id, state_code, county_code FROM location)
NATURAL JOIN (SELECT pollutant_code, pollutant_name FROM pollutant)
"""
_DAILY = _TREND.format(
    names="day_utc", periods="CAST(timestamp_start_utc AS DATE) AS day_utc", extra=", final_count, provisional_count"
)


@register("daily_trend", with_views("cur location pollutant", _DAILY))
def _daily_trend(spark, sf):
    t = fx.tables(spark, sf)
    return as_date(rounded(marts.daily_trend(t.current, t.location, t.pollutant), "avg_value"), "day_utc")


@register(
    "monthly_trend",
    with_views(
        "cur location pollutant",
        _TREND.format(
            names="month_utc", periods="make_date(year(timestamp_start_utc), month(timestamp_start_utc), 1) AS month_utc", extra=""
        ),
    ),
)
def _monthly_trend(spark, sf):
    t = fx.tables(spark, sf)
    return as_date(rounded(marts.monthly_trend(t.current, t.location, t.pollutant), "avg_value"), "month_utc")


@register(
    "seasonal_trend",
    with_views(
        "cur location pollutant",
        _TREND.format(
            names="year_utc, quarter_utc",
            periods="CAST(year(timestamp_start_utc) AS INTEGER) AS year_utc, "
            "CAST((month(timestamp_start_utc) + 2) // 3 AS INTEGER) AS quarter_utc",
            extra="",
        ),
    ),
)
def _seasonal_trend(spark, sf):
    t = fx.tables(spark, sf)
    return rounded(marts.seasonal_trend(t.current, t.location, t.pollutant), "avg_value")


@register(
    "station_totals",
    with_views(
        "cur location",
        """SELECT state_code, county_code, pollutant_code, count(*) AS total_station_count
           FROM (SELECT DISTINCT location_id, pollutant_code FROM cur WHERE data_granularity = 'daily')
           NATURAL JOIN (SELECT location_id, state_code, county_code FROM location) GROUP BY ALL""",
    ),
)
def _station_totals(spark, sf):
    t = fx.tables(spark, sf)
    return marts.station_totals(t.current, t.location)


_COVERAGE = """
station_days AS (
  SELECT location_id, pollutant_code, CAST(timestamp_start_utc AS DATE) AS day_utc, count(*) AS n
  FROM cur WHERE data_granularity = 'daily' GROUP BY ALL),
placed AS (
  SELECT * FROM station_days NATURAL JOIN (SELECT location_id, state_code, county_code FROM location)
  WHERE state_code IS NOT NULL AND county_code IS NOT NULL),
ever AS (
  SELECT {'s': state_code, 'c': county_code, 'p': pollutant_code} AS region, len(list_distinct(list(location_id))) AS stations
  FROM placed GROUP BY region),
coverage AS (
  SELECT state_code, county_code, pollutant_code, pollutant_name, day_utc, CAST(sum(n) AS BIGINT) AS observation_count,
         count(*) AS reporting_station_count, any_value(stations)::BIGINT AS total_station_count,
         count(*)::DOUBLE / any_value(stations) AS station_coverage_ratio
  FROM placed NATURAL JOIN (SELECT pollutant_code, pollutant_name FROM pollutant)
  JOIN ever ON region = {'s': state_code, 'c': county_code, 'p': pollutant_code}
  GROUP BY ALL)
"""


@register(
    "region_coverage",
    with_views(
        "cur location pollutant",
        f", {_COVERAGE} SELECT * REPLACE (round(station_coverage_ratio, 6) AS station_coverage_ratio) FROM coverage",
    ),
)
def _region_coverage(spark, sf):
    t = fx.tables(spark, sf)
    return as_date(
        rounded(marts.region_coverage(t.current, t.location, t.pollutant), "station_coverage_ratio"), "day_utc"
    )


@register(
    "exceedance_events",
    with_views(
        "cur location pollutant threshold",
        """SELECT over.natural_key, over.location_id, state_code, county_code, limits.pollutant_code, pollutant_name,
                  over.value_numeric, over.unit, over.timestamp_start_utc, over.timestamp_local, over.source_system,
                  over.data_status, threshold_type, threshold_value, round(margin, 6) AS exceedance_margin,
                  round(if(threshold_value > 0, 1 + margin / threshold_value, NULL), 6) AS exceedance_ratio
           FROM (SELECT * FROM threshold WHERE is_active) limits,
           LATERAL (SELECT *, value_numeric - limits.threshold_value AS margin FROM cur
                    WHERE pollutant_code = limits.pollutant_code AND unit = limits.unit AND data_granularity = 'daily') over,
           location place, pollutant name
           WHERE margin > 0 AND place.location_id = over.location_id AND name.pollutant_code = limits.pollutant_code""",
    ),
)
def _exceedance_events(spark, sf):
    t = fx.tables(spark, sf)
    events = marts.exceedance_events(t.current, t.location, t.pollutant, t.threshold)
    return rounded(events, "exceedance_margin", "exceedance_ratio")


_REGION_DAYS = """
days AS (
  SELECT {'s': state_code, 'c': county_code, 'p': pollutant_code} AS region, CAST(timestamp_start_utc AS DATE) AS day_utc,
         sum(value_numeric) / count(*) AS day_avg_value, count(*) AS observation_count
  FROM cur NATURAL JOIN (SELECT location_id, state_code, county_code FROM location)
  WHERE data_granularity = 'daily' GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY day_utc) AS nth FROM days),
before AS (
  SELECT d.region, d.nth, avg(e.day_avg_value) AS baseline_avg_value, stddev_samp(e.day_avg_value) AS baseline_stddev
  FROM numbered d JOIN numbered e ON e.region IS NOT DISTINCT FROM d.region AND e.nth BETWEEN d.nth - 30 AND d.nth - 1
  GROUP BY d.region, d.nth),
scored AS (
  SELECT region.s AS state_code, region.c AS county_code, region.p AS pollutant_code, day_utc, day_avg_value,
         observation_count, baseline_avg_value, baseline_stddev
  FROM numbered LEFT JOIN before USING (region, nth))
"""


@register(
    "region_day_average",
    with_views(
        "cur location",
        f""", {_REGION_DAYS}
        SELECT state_code, county_code, pollutant_code, day_utc, round(day_avg_value, 6) AS day_avg_value, observation_count
        FROM scored""",
    ),
)
def _region_day_average(spark, sf):
    t = fx.tables(spark, sf)
    return as_date(rounded(marts.region_day_average(t.current, t.location), "day_avg_value"), "day_utc")


@register(
    "trailing_baseline",
    with_views(
        "cur location",
        f""", {_REGION_DAYS} SELECT state_code, county_code, pollutant_code, day_utc, observation_count,
               round(day_avg_value, 6) AS day_avg_value, round(baseline_avg_value, 6) AS baseline_avg_value,
               round(baseline_stddev, 6) AS baseline_stddev FROM scored""",
    ),
)
def _trailing_baseline(spark, sf):
    t = fx.tables(spark, sf)
    scored = marts.with_trailing_baseline(marts.region_day_average(t.current, t.location))
    return as_date(rounded(scored, "day_avg_value", "baseline_avg_value", "baseline_stddev"), "day_utc")


@register(
    "anomaly_spikes",
    with_views(
        "cur location pollutant",
        f""", {_REGION_DAYS}
        SELECT s.state_code, s.county_code, s.pollutant_code, p.pollutant_name, s.day_utc,
               round(s.day_avg_value, 6) AS day_avg_value, s.observation_count,
               round(s.baseline_avg_value, 6) AS baseline_avg_value, round(s.baseline_stddev, 6) AS baseline_stddev,
               round(s.day_avg_value - s.baseline_avg_value, 6) AS anomaly_delta,
               round((s.day_avg_value - s.baseline_avg_value) / s.baseline_stddev, 6) AS anomaly_zscore
        FROM scored s JOIN pollutant p USING (pollutant_code)
        WHERE s.baseline_stddev > 0 AND abs((s.day_avg_value - s.baseline_avg_value) / s.baseline_stddev) >= 2.5""",
    ),
)
def _anomaly_spikes(spark, sf):
    t = fx.tables(spark, sf)
    spikes = marts.anomaly_spikes(t.current, t.location, t.pollutant)
    return as_date(
        rounded(spikes, "day_avg_value", "baseline_avg_value", "baseline_stddev", "anomaly_delta", "anomaly_zscore"),
        "day_utc",
    )


# --- serving -----------------------------------------------------------------

_LATEST_ITEMS = """natural_key, location_id, state_code, county_code, site_name, city_name, latitude, longitude,
    pollutant_code, pollutant_name, value_numeric, unit, timestamp_start_utc, source_system, data_status,
    threshold_type, threshold_value, is_exceedance"""


@register(
    "api_latest",
    with_views(
        "cur location pollutant threshold",
        f""", {_LATEST}, mart AS ({_LATEST_SELECT})
        SELECT {_LATEST_ITEMS} FROM mart
        ORDER BY timestamp_start_utc DESC NULLS FIRST, pollutant_code, location_id, threshold_type LIMIT 100 OFFSET 20""",
    ),
)
def _api_latest(spark, sf):
    return serving.latest(fx.tables(spark, sf, with_ingestion=True), limit=100, offset=20)


@register(
    "api_latest_filtered",
    with_views(
        "cur location pollutant threshold",
        f""", {_LATEST}, mart AS ({_LATEST_SELECT})
        SELECT {_LATEST_ITEMS} FROM mart
        WHERE pollutant_code = 'ECONOMY' AND state_code = '05' AND timestamp_start_utc >= TIMESTAMP '1998-06-01 00:00:00'
        ORDER BY timestamp_start_utc DESC NULLS FIRST, pollutant_code, location_id, threshold_type LIMIT 1000""",
    ),
)
def _api_latest_filtered(spark, sf):
    return serving.latest(
        fx.tables(spark, sf, with_ingestion=True),
        pollutant_code="ECONOMY",
        state_code="05",
        updated_after_utc=datetime(1998, 6, 1),
        limit=1000,
    )


_MAP = """
tops AS (
  SELECT arg_max(h, {{'a': timestamp_start_utc, 'b': ingested_at, 'c': record_hash}}) AS fact
  FROM history h WHERE {where} GROUP BY location_id, pollutant_code, source_system, data_granularity),
points AS (
  SELECT fact.natural_key, fact.location_id, place.state_code, place.county_code, place.site_name, place.city_name,
         place.latitude, place.longitude, fact.pollutant_code, name.pollutant_name, fact.value_numeric, fact.unit,
         fact.timestamp_start_utc, fact.data_granularity, fact.data_status, fact.source_system, fact.source_dataset,
         fact.value_numeric > (SELECT min(t.threshold_value) FROM threshold t WHERE t.is_active
           AND t.pollutant_code = fact.pollutant_code AND t.unit = fact.unit) AS is_exceedance
  FROM tops, location place, pollutant name
  WHERE place.location_id = fact.location_id AND name.pollutant_code = fact.pollutant_code
    AND place.latitude + place.longitude IS NOT NULL {location_where}
  ORDER BY fact.timestamp_start_utc DESC, fact.pollutant_code, fact.location_id, fact.source_system, fact.data_granularity
  {limit})
"""


@register(
    "api_map_latest",
    with_views(
        "history location pollutant threshold",
        ", " + _MAP.format(where="true", location_where="", limit="LIMIT 1000") + " SELECT * FROM points",
    ),
)
def _api_map_latest(spark, sf):
    return serving.map_latest(fx.tables(spark, sf))


@register(
    "api_map_latest_filtered",
    with_views(
        "history location pollutant threshold",
        ", "
        + _MAP.format(
            where="h.source_system IN ('AQS') AND h.data_granularity IN ('daily', 'hourly')",
            location_where="AND place.state_code = '07'",
            limit="LIMIT 5000",
        )
        + " SELECT * FROM points",
    ),
)
def _api_map_latest_filtered(spark, sf):
    return serving.map_latest(
        fx.tables(spark, sf), state_code="07", source_systems=["AQS"], data_granularities=["daily", "hourly"], limit=5000
    )


@register(
    "map_kpis",
    with_views(
        "history location pollutant threshold",
        ", "
        + _MAP.format(where="true", location_where="", limit="")
        + """ SELECT count(*) FILTER (WHERE coalesce(is_exceedance, false)) AS exceedance_points,
                     string_agg(DISTINCT source_system, ', ' ORDER BY source_system) AS sources_shown FROM points""",
    ),
)
def _map_kpis(spark, sf):
    return serving.map_kpis(serving.map_points(fx.tables(spark, sf)))


@register(
    "api_timeseries",
    with_views(
        "cur location pollutant",
        f""", mart AS ({_DAILY})
        SELECT location_id, pollutant_code, pollutant_name, day_utc, avg_value, min_value, max_value, observation_count,
               final_count, provisional_count
        FROM mart WHERE location_id LIKE 'aqs:%:002:0007:1' AND pollutant_code = 'PROMO'
          AND day_utc >= DATE '1996-01-01' AND day_utc <= DATE '2001-12-31'
        ORDER BY day_utc LIMIT 365""",
    ),
)
def _api_timeseries(spark, sf):
    t = fx.tables(spark, sf)
    # the station id carries the nation of supplier 7, which differs by data set
    nation = fx.table(spark, sf, "supplier").where("s_suppkey = 7").select("s_nationkey").first()[0]
    series = serving.timeseries(
        t,
        f"aqs:{nation:02d}:002:0007:1",
        "PROMO",
        start_day_utc=datetime(1995, 12, 31, 6),
        end_day_utc=datetime(2001, 12, 31),
    )
    return as_date(rounded(series, "avg_value"), "day_utc")


@register(
    "api_coverage",
    with_views(
        "cur location pollutant",
        f""", {_COVERAGE}
        SELECT * REPLACE (round(station_coverage_ratio, 6) AS station_coverage_ratio) FROM coverage
        WHERE pollutant_code = 'LARGE' AND day_utc >= DATE '1995-03-01' AND day_utc <= DATE '1999-03-01'
          AND station_coverage_ratio >= 0.25
        ORDER BY day_utc DESC, pollutant_code, state_code, county_code LIMIT 2000""",
    ),
)
def _api_coverage(spark, sf):
    rows = serving.coverage(
        fx.tables(spark, sf),
        pollutant_code="LARGE",
        start_day_utc=datetime(1995, 3, 1),
        end_day_utc=datetime(1999, 3, 1),
        min_coverage_ratio=0.25,
        limit=2000,
    )
    return as_date(rounded(rows, "station_coverage_ratio"), "day_utc")


@register(
    "regional_trend",
    with_views(
        "cur location pollutant",
        f""", {_COVERAGE}
        SELECT day_utc, CAST(sum(observation_count) AS BIGINT) AS observation_count,
               round(avg(station_coverage_ratio), 6) AS avg_station_coverage_ratio
        FROM coverage GROUP BY day_utc""",
    ),
)
def _regional_trend(spark, sf):
    t = fx.tables(spark, sf)
    trend = serving.regional_trend(marts.region_coverage(t.current, t.location, t.pollutant))
    return as_date(rounded(trend, "avg_station_coverage_ratio"), "day_utc")


@register(
    "completeness_kpis",
    with_views(
        "cur location pollutant",
        f""", {_COVERAGE}
        SELECT round(avg(station_coverage_ratio) FILTER (WHERE day_utc = (SELECT max(day_utc) FROM coverage)), 6)
                 AS latest_day_avg_coverage,
               count(*) FILTER (WHERE station_coverage_ratio < 0.7) AS rows_below_ratio
        FROM coverage""",
    ),
)
def _completeness_kpis(spark, sf):
    t = fx.tables(spark, sf)
    kpis = serving.completeness_kpis(marts.region_coverage(t.current, t.location, t.pollutant))
    return rounded(kpis, "latest_day_avg_coverage")
