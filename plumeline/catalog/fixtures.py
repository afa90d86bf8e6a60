"""Observation tables derived from the sample Parquet tables.

``lineitem`` with its supplier, part and order plays the fact history,
``supplier`` the stations, ``part`` the pollutants and ``events`` the raw
provisional feed.  Each view has the same definition in SQL (``SQL`` below)
for the oracle queries.  All views cover their whole tables.
"""

from __future__ import annotations

from functools import cached_property, lru_cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions import zero_fill
from plumeline.plans.serving import Tables
from plumeline.session import broadcast_if_small, scratch_dir, shuffles_freed
from plumeline.sources.config import local_rows

SPLIT_DATE = "1998-01-01"


@lru_cache(maxsize=256)  # lazy plans, built once per session
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(column: str | Column, width: int) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return zero_fill(value.cast("string"), width)


def _location_id(supplier: str = "s_suppkey") -> Column:
    return F.concat(
        F.lit("aqs:"), _code("s_nationkey", 2), F.lit(":"), _code(F.col(supplier) % 5, 3),
        F.lit(":"), _code(supplier, 4), F.lit(":1"),
    )


@lru_cache(maxsize=64)
def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per supplier; NULL state for nation 24, some without latitude."""
    supplier = table(spark, sf_dir, "supplier")
    nation = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _location_id().alias("location_id"),
        F.lit("site_monitor").alias("location_type"),
        F.lit("US").alias("country_code"),
        F.when(F.col("s_nationkey") != 24, _code("s_nationkey", 2)).alias("state_code"),
        _code(F.col("s_suppkey") % 5, 3).alias("county_code"),
        _code("s_suppkey", 4).alias("site_number"),
        F.concat(_code("s_nationkey", 2), _code(F.col("s_suppkey") % 5, 3), _code("s_suppkey", 4)).alias("aqsid"),
        F.col("s_name").alias("site_name"),
        F.col("n_name").alias("city_name"),
        F.when(F.col("s_suppkey") % 11 != 0, F.col("s_nationkey").cast("double")).alias("latitude"),
        (-F.col("s_suppkey")).cast("double").alias("longitude"),
    )
    return broadcast_if_small(joined, bounded_by=supplier)


@lru_cache(maxsize=64)
def pollutant(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("pollutant_code")).distinct()
    return names.select(
        "pollutant_code",
        F.concat(F.lit("name "), F.col("pollutant_code")).alias("pollutant_name"),
        F.lit("qty").alias("default_unit"),
    )


# Thresholds: three active, one inactive, one in a unit no observation has.
_THRESHOLDS = [
    ("ECONOMY", "std", 45.0, "qty", True),
    ("PROMO", "std", 40.0, "qty", True),
    ("LARGE", "std", 30.0, "qty", True),
    ("SMALL", "std", 10.0, "qty", False),
    ("MEDIUM", "std", 10.0, "ppm", True),
]


@lru_cache(maxsize=64)
def threshold(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return local_rows(
        spark,
        _THRESHOLDS,
        "pollutant_code string, threshold_type string, threshold_value double, unit string, is_active boolean",
    )


@lru_cache(maxsize=64)
def history(spark: SparkSession, sf_dir: str, with_ingestion: bool = True, by_station: bool = False) -> DataFrame:
    """Fact history with month-level keys, so sources and revisions collide.

    ``with_ingestion=False`` leaves out ``ingested_at`` and with it the join to
    ``orders`` for readers that never look at ingestion times.  ``by_station=True``
    is for readers that rank or group within stations (see ``_lines_by_station``).
    """
    joined = _lines_by_station(spark, sf_dir, with_ingestion) if by_station else _joined_lines(spark, sf_dir, with_ingestion)
    return _history_of(joined, with_ingestion)


def _joined_lines(spark: SparkSession, sf_dir: str, with_ingestion: bool) -> DataFrame:
    joined = _with_parts(spark, sf_dir, _with_stations(spark, sf_dir, table(spark, sf_dir, "lineitem")))
    return _with_orders(spark, sf_dir, joined) if with_ingestion else joined


def _lines_by_station(spark: SparkSession, sf_dir: str, with_ingestion: bool) -> DataFrame:
    """The rows of :func:`_joined_lines`, those of a station in one task: stations are joined last, by a shuffle of the
    narrow lines, so that a first row per station and more is found before the wide rows are shuffled for the ranking."""
    joined = table(spark, sf_dir, "lineitem")
    if with_ingestion:
        joined = _with_orders(spark, sf_dir, joined)
    return _with_stations(spark, sf_dir, _with_parts(spark, sf_dir, joined), shuffled=True)


def _with_stations(spark: SparkSession, sf_dir: str, lines: DataFrame, shuffled: bool = False) -> DataFrame:
    stations = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    stations = stations.hint("merge") if shuffled else broadcast_if_small(stations)
    return lines.join(stations, F.col("l_suppkey") == F.col("s_suppkey"))


def _with_parts(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    parts = broadcast_if_small(table(spark, sf_dir, "part").select("p_partkey", "p_type"))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _with_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    orders = broadcast_if_small(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _history_of(joined: DataFrame, with_ingestion: bool) -> DataFrame:
    granularity = (
        F.when(F.col("l_returnflag") == "N", "daily").when(F.col("l_returnflag") == "A", "hourly").otherwise("sample")
    )
    final = F.col("l_linestatus") == "F"
    station = _location_id("l_suppkey")  # the same key as the station's, which later joins then need not carry
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM").cast("string")
    columns = [
        F.concat_ws("|", station, F.col("p_type"), F.lit("concentration"), granularity, month).alias("natural_key"),
        station.alias("location_id"),
        F.col("p_type").alias("pollutant_code"),
        F.lit("concentration").alias("metric_type"),
        F.col("l_quantity").alias("value_numeric"),
        F.lit("qty").alias("unit"),
        granularity.alias("data_granularity"),
        F.col("l_shipdate").alias("timestamp_start_utc"),
        F.col("l_shipdate").alias("timestamp_local"),
        F.when(final, "AQS").otherwise("AIRNOW").alias("source_system"),
        F.concat(F.lit("feed_"), granularity).alias("source_dataset"),
        F.when(final, 100).otherwise(10).alias("source_priority"),
        F.when(final, "final").otherwise("provisional").alias("data_status"),
        F.col("l_shipdate").cast("date").alias("source_last_modified_date"),
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        ).alias("record_hash"),
    ]
    if with_ingestion:
        columns.append(F.col("o_orderdate").alias("ingested_at"))
    return joined.select(*columns)


# The columns of the joined tables that history is made of.
_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate",
    "s_nationkey", "p_type", "o_orderdate",
)


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`history` for queries that read it more than once: where the joined tables are too large to broadcast, every
    reading would shuffle all lines once per join, so the joined lines are written to the shared folder, anew for each call."""
    path = f"{scratch_dir(spark)}/lines-{uuid4().hex}"
    joined = _joined_lines(spark, sf_dir, True).select(*_LINE_COLUMNS)
    with shuffles_freed(spark):
        joined.write.option("compression", "zstd").parquet(path)
    return _history_of(spark.read.schema(joined.schema).parquet(path), True)


@lru_cache(maxsize=64)
def current_rows(spark: SparkSession, sf_dir: str, with_ingestion: bool = False) -> DataFrame:
    """All history rows as current rows (``natural_key`` := ``record_hash``): volume for the marts."""
    rows = history(spark, sf_dir, with_ingestion).withColumn("natural_key", F.col("record_hash"))
    return rows.withColumnRenamed("ingested_at", "updated_at") if with_ingestion else rows


class SampleTables(Tables):
    """The views as serving tables, each built when first read."""

    def __init__(self, spark: SparkSession, sf_dir: str, with_ingestion: bool):
        vars(self).update(_spark=spark, _dir=sf_dir, _ingestion=with_ingestion)

    current = cached_property(lambda self: current_rows(self._spark, self._dir, self._ingestion))
    history = cached_property(lambda self: history(self._spark, self._dir, by_station=True))
    location = cached_property(lambda self: location(self._spark, self._dir))
    pollutant = cached_property(lambda self: pollutant(self._spark, self._dir))
    threshold = cached_property(lambda self: threshold(self._spark))


def tables(spark: SparkSession, sf_dir: str, with_ingestion: bool = False) -> Tables:
    return SampleTables(spark, sf_dir, with_ingestion)


@lru_cache(maxsize=64)
def split_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """History as (already loaded, incoming) by ingestion date; together the whole table."""
    return split_by_date(history(spark, sf_dir))


def stored_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """:func:`split_batches` of :func:`stored_history`."""
    return split_by_date(stored_history(spark, sf_dir))


def split_by_date(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    split = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return rows.where(F.col("ingested_at") < split), rows.where(F.col("ingested_at") >= split)


@lru_cache(maxsize=64)
def raw_provisional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw provisional feed rows, all text: several site-id, date and time layouts,
    missing offsets, unusable values."""
    event, user = F.col("event_id"), F.col("user_id")
    text = F.col("ts").cast("string")
    year, month, day = F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2)
    state, county, site = _code(user % 25, 2), _code(user % 7, 3), _code(user, 4)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "PM2.5")
        .when(F.col("event_type") == "click", "OZONE")
        .when(F.col("event_type") == "purchase", "CO")
        .when(F.col("event_type") == "error", "so2")
        .otherwise("unknown")
        .alias("parameter_name"),
        F.when(event % 17 == 0, "06001000")
        .when(event % 2 == 1, F.concat_ws("-", state, county, site))
        .otherwise(F.concat(F.lit("840"), state, county, site))
        .alias("aqsid_raw"),
        F.when(event % 4 == 0, F.substring(text, 1, 10))
        .when(event % 4 == 1, F.concat_ws("/", year, month, day))
        .when(event % 4 == 2, F.concat_ws("/", month, day, F.substring(text, 3, 2)))
        .otherwise(F.concat_ws("/", month, day, year))
        .alias("valid_date"),
        F.when(event % 3 == 0, F.substring(text, 12, 2))
        .when(event % 23 == 0, "24")
        .otherwise(F.substring(text, 12, 5))
        .alias("valid_time"),
        F.when(event % 13 == 0, F.lit(None).cast("string"))
        .when(event % 13 == 1, "5.5")
        .otherwise((user % 12 - 8).cast("string"))
        .alias("gmt_offset"),
        F.when(event % 19 == 0, "n/a")
        .when(event % 29 == 0, "")
        .otherwise(F.floor("value").cast("string"))
        .alias("value_text"),
        F.when(event % 5 == 0, " ").otherwise("ug/m3").alias("unit_text"),
    )


# The same views in SQL ------------------------------------------------------

def _sql_code(expr: str, width: int) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


_SQL_STATION = (
    f"concat('aqs:', {_sql_code('s_nationkey', 2)}, ':', {_sql_code('s_suppkey % 5', 3)}, ':', "
    f"{_sql_code('s_suppkey', 4)}, ':1')"
)
_SQL_GRANULARITY = "CASE l_returnflag WHEN 'N' THEN 'daily' WHEN 'A' THEN 'hourly' ELSE 'sample' END"
_SQL_THRESHOLDS = ", ".join(
    f"('{code}', '{kind}', {value}, '{unit}', {str(active).lower()})" for code, kind, value, unit, active in _THRESHOLDS
)

SQL = {
    "location": f"""
        SELECT {_SQL_STATION} AS location_id, 'site_monitor' AS location_type, 'US' AS country_code,
               CASE WHEN s_nationkey <> 24 THEN {_sql_code('s_nationkey', 2)} END AS state_code,
               {_sql_code('s_suppkey % 5', 3)} AS county_code, {_sql_code('s_suppkey', 4)} AS site_number,
               concat({_sql_code('s_nationkey', 2)}, {_sql_code('s_suppkey % 5', 3)}, {_sql_code('s_suppkey', 4)}) AS aqsid,
               s_name AS site_name, n_name AS city_name,
               CASE WHEN s_suppkey % 11 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS latitude,
               CAST(-s_suppkey AS DOUBLE) AS longitude
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "pollutant": """
        SELECT DISTINCT p_type AS pollutant_code, concat('name ', p_type) AS pollutant_name, 'qty' AS default_unit
        FROM part""",
    "threshold": f"""
        SELECT pollutant_code, threshold_type, CAST(threshold_value AS DOUBLE) AS threshold_value, unit, is_active
        FROM (VALUES {_SQL_THRESHOLDS}) AS t(pollutant_code, threshold_type, threshold_value, unit, is_active)""",
    "history": f"""
        SELECT concat_ws('|', {_SQL_STATION}, p_type, 'concentration', {_SQL_GRANULARITY},
                         CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR)) AS natural_key,
               {_SQL_STATION} AS location_id, p_type AS pollutant_code, 'concentration' AS metric_type,
               l_quantity AS value_numeric, 'qty' AS unit, {_SQL_GRANULARITY} AS data_granularity,
               l_shipdate AS timestamp_start_utc, l_shipdate AS timestamp_local,
               CASE l_linestatus WHEN 'F' THEN 'AQS' ELSE 'AIRNOW' END AS source_system,
               concat('feed_', {_SQL_GRANULARITY}) AS source_dataset,
               CAST(CASE l_linestatus WHEN 'F' THEN 100 ELSE 10 END AS INTEGER) AS source_priority,
               CASE l_linestatus WHEN 'F' THEN 'final' ELSE 'provisional' END AS data_status,
               CAST(l_shipdate AS DATE) AS source_last_modified_date,
               concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS record_hash,
               o_orderdate AS ingested_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "cur": """
        SELECT * REPLACE (record_hash AS natural_key), ingested_at AS updated_at FROM history""",
    "existing": f"SELECT * FROM history WHERE ingested_at < TIMESTAMP '{SPLIT_DATE} 00:00:00'",
    "incoming": f"SELECT * FROM history WHERE ingested_at >= TIMESTAMP '{SPLIT_DATE} 00:00:00'",
    "raw_provisional": f"""
        SELECT event_id,
               CASE event_type WHEN 'view' THEN 'PM2.5' WHEN 'click' THEN 'OZONE' WHEN 'purchase' THEN 'CO'
                    WHEN 'error' THEN 'so2' ELSE 'unknown' END AS parameter_name,
               CASE WHEN event_id % 17 = 0 THEN '06001000'
                    WHEN event_id % 2 = 1 THEN concat_ws('-', {_sql_code('user_id % 25', 2)}, {_sql_code('user_id % 7', 3)}, {_sql_code('user_id', 4)})
                    ELSE concat('840', {_sql_code('user_id % 25', 2)}, {_sql_code('user_id % 7', 3)}, {_sql_code('user_id', 4)}) END AS aqsid_raw,
               CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y/%m/%d')
                    WHEN 2 THEN strftime(ts, '%m/%d/%y') ELSE strftime(ts, '%m/%d/%Y') END AS valid_date,
               CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%H') WHEN event_id % 23 = 0 THEN '24'
                    ELSE strftime(ts, '%H:%M') END AS valid_time,
               CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 13 = 1 THEN '5.5'
                    ELSE CAST(user_id % 12 - 8 AS VARCHAR) END AS gmt_offset,
               CASE WHEN event_id % 19 = 0 THEN 'n/a' WHEN event_id % 29 = 0 THEN ''
                    ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value_text,
               CASE WHEN event_id % 5 = 0 THEN ' ' ELSE 'ug/m3' END AS unit_text
        FROM events""",
}
_NEEDS = {"cur": ("history",), "existing": ("history",), "incoming": ("history",)}


def with_views(views: str, body: str) -> str:
    """``body`` preceded by the named views (space separated) as CTEs."""
    ordered: list[str] = []
    for name in views.split():
        for item in (*_NEEDS.get(name, ()), name):
            if item not in ordered:
                ordered.append(item)
    ctes = ",\n".join(f"{name} AS ({SQL[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if not body.lstrip().startswith(",") else f"WITH {ctes}{body}"
