"""Feed parsing, normalisation, validation, landing and ledger queries with their SQL oracles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.catalog import fixtures as fx
from plumeline.catalog.fixtures import with_views
from plumeline.catalog.merge_queries import as_ntz, region_states
from plumeline.operators import landing, ledger, normalise, validate
from plumeline.operators.ranking import evaluated
from plumeline.operators.windows import months_between, years_between
from plumeline.plans import refresh
from plumeline.sources import config
from plumeline.sources.delimited import parse_hourly_lines
from plumeline.sources.documents import authoritative_rows, gap_fill_rows
from plumeline.sources.staging import landed_month

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(fn_):
        QUERIES[name] = fn_
        if sql is not None:
            ORACLES[name] = sql
        return fn_

    return add


# --- expressions over the raw provisional feed ----------------------------------

_DIGITS = "regexp_replace(aqsid_raw, '[^0-9]', '', 'g')"
_SITE = f"CASE WHEN length({_DIGITS}) >= 9 THEN right({_DIGITS}, 9) END"
_DATE = """CASE WHEN valid_date LIKE '____-__-__' THEN CAST(strptime(valid_date, '%Y-%m-%d') AS DATE)
                WHEN valid_date LIKE '____/__/__' THEN CAST(strptime(valid_date, '%Y/%m/%d') AS DATE)
                WHEN valid_date LIKE '__/__/____' THEN CAST(strptime(valid_date, '%m/%d/%Y') AS DATE)
                WHEN valid_date LIKE '__/__/__' THEN CAST(strptime(valid_date, '%m/%d/%y') AS DATE) END"""
_HOUR = """CASE WHEN TRY_CAST(split_part(valid_time, ':', 1) AS INTEGER) BETWEEN 0 AND 23
                THEN CAST(split_part(valid_time, ':', 1) AS INTEGER) END"""
_LOCAL = f"(CAST({_DATE} AS TIMESTAMP) + to_hours({_HOUR}))"
_UTC = f"({_LOCAL} - to_minutes(CAST(coalesce(TRY_CAST(gmt_offset AS DOUBLE), 0) * 60 AS INTEGER)))"
_POLLUTANT = """CASE regexp_replace(lower(parameter_name), '[^a-z0-9.]', '', 'g') WHEN 'pm2.5' THEN '88101'
                     WHEN 'ozone' THEN '44201' WHEN 'co' THEN '42101' WHEN 'so2' THEN '42401' END"""


@register(
    "parse_site_id",
    with_views(
        "raw_provisional",
        f"""SELECT event_id, {_SITE} AS aqsid,
                   CASE WHEN {_SITE} IS NULL THEN concat('airnow:', aqsid_raw)
                        ELSE concat('aqs_site:', substring({_SITE}, 1, 2), ':', substring({_SITE}, 3, 3), ':', substring({_SITE}, 6, 4))
                   END AS site_location_id
            FROM raw_provisional""",
    ),
)
def _parse_site_id(spark, sf):
    raw = F.col("aqsid_raw")
    return fx.raw_provisional(spark, sf).select(
        "event_id",
        fn.normalize_site_id(raw).alias("aqsid"),
        fn.site_location_id(site_id=raw, fallback=F.concat(F.lit("airnow:"), raw)).alias("site_location_id"),
    )


@register(
    "zero_fill_codes",
    f"""SELECT s_suppkey, {fx._sql_code('s_nationkey', 2)} AS state,
               CASE WHEN s_acctbal < 0 THEN '0na' ELSE {fx._sql_code('s_suppkey', 3)} END AS county,
               concat('aqs_site:', {fx._sql_code('s_nationkey', 2)}, ':',
                      CASE WHEN s_acctbal < 0 THEN '0na' ELSE {fx._sql_code('s_suppkey', 3)} END, ':',
                      {fx._sql_code('s_suppkey', 4)}) AS site_location_id
        FROM supplier""",
)
def _zero_fill_codes(spark, sf):
    county = F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string")).otherwise(" ")
    rows = fx.table(spark, sf, "supplier").select(
        "s_suppkey",
        fn.zero_fill_code(F.col("s_nationkey").cast("string"), 2).alias("state"),
        fn.zero_fill_code(county, 3).alias("county"),
    )
    site = fn.site_location_id(
        state_code=F.col("state"), county_code=F.col("county"), site_number=F.col("s_suppkey").cast("string")
    )
    return rows.withColumn("site_location_id", site)


@register(
    "parse_dates",
    with_views(
        "raw_provisional", f"SELECT event_id, {_DATE} AS feed_date, {_HOUR} AS feed_hour FROM raw_provisional"
    ),
)
def _parse_dates(spark, sf):
    return fx.raw_provisional(spark, sf).select(
        "event_id",
        fn.parse_feed_date(F.col("valid_date")).alias("feed_date"),
        fn.parse_hour(F.col("valid_time")).alias("feed_hour"),
    )


@register(
    "parse_timestamps",
    """SELECT event_id, date_trunc('minute', ts) AS from_pair, date_trunc('second', ts) + INTERVAL 7 HOUR AS from_iso,
              CAST(ts AS DATE) AS from_compact FROM events""",
)
def _parse_timestamps(spark, sf):
    ts = F.col("ts")
    rows = fx.table(spark, sf, "events").select(
        "event_id",
        fn.parse_date_time(F.date_format(ts, "yyyy-M-d"), F.date_format(ts, "H:m")).alias("from_pair"),
        fn.parse_utc_timestamp(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-07:00"))).alias("from_iso"),
        fn.parse_iso_date(F.date_format(ts, "yyyyMMdd")).alias("from_compact"),
    )
    return as_ntz(rows, "from_pair", "from_iso")


@register(
    "resolve_offsets",
    with_views(
        "raw_provisional", f"SELECT event_id, {_LOCAL} AS timestamp_local, {_UTC} AS timestamp_utc FROM raw_provisional"
    ),
)
def _resolve_offsets(spark, sf):
    rows = fx.raw_provisional(spark, sf).select(
        "event_id",
        fn.local_timestamp(F.col("valid_date"), F.col("valid_time")).alias("timestamp_local"),
        fn.parse_offset_hours(F.col("gmt_offset")).alias("offset_hours"),
    )
    utc = fn.local_to_utc(F.col("timestamp_local"), F.col("offset_hours"))
    return as_ntz(rows.withColumn("timestamp_utc", utc).drop("offset_hours"), "timestamp_local", "timestamp_utc")


@register(
    "pollutant_alias",
    with_views(
        "raw_provisional",
        f"""SELECT event_id, {_POLLUTANT} AS pollutant_code FROM raw_provisional WHERE {_POLLUTANT} IS NOT NULL""",
    ),
)
def _pollutant_alias(spark, sf):
    rows = fx.raw_provisional(spark, sf).select("event_id", fn.pollutant_key(F.col("parameter_name")).alias("alias_key"))
    return rows.join(F.broadcast(config.pollutant_aliases(spark)), "alias_key").select("event_id", "pollutant_code")


@register(
    "first_nonzero_measure",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CASE WHEN l_discount <> 0 THEN l_discount WHEN l_tax <> 0 THEN l_tax ELSE l_quantity END AS value_numeric
       FROM lineitem""",
)
def _first_nonzero_measure(spark, sf):
    value = fn.first_nonzero(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity"))
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", value.alias("value_numeric")
    )


@register(
    "natural_keys",
    """SELECT event_id, concat('site', CAST(user_id AS VARCHAR), '|', event_type, '|concentration|hourly|',
                               strftime(ts, '%Y-%m-%dT%H:%M:%S'),
                               CASE WHEN microsecond(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END, '+00:00') AS natural_key
       FROM events""",
)
def _natural_keys(spark, sf):
    key = fn.natural_key(
        F.concat(F.lit("site"), F.col("user_id").cast("string")), F.col("event_type"), F.lit("concentration"),
        F.lit("hourly"), fn.iso_text(F.col("ts")),
    )
    return fx.table(spark, sf, "events").select("event_id", key.alias("natural_key"))


@register(
    "record_hashes",
    """SELECT o_orderkey, sha256(concat('{"customer":', CAST(o_custkey AS VARCHAR), ',"priority":"', o_orderpriority,
                                        '","remark":null,"status":"', o_orderstatus, '"}')) AS record_hash
       FROM orders""",
)
def _record_hashes(spark, sf):
    hashed = fn.record_hash(
        status=F.col("o_orderstatus"), customer=F.col("o_custkey"), priority=F.col("o_orderpriority"),
        remark=F.lit(None).cast("string"),
    )
    return fx.table(spark, sf, "orders").select("o_orderkey", hashed.alias("record_hash"))


@register(
    "month_windows",
    """WITH r AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                  FROM orders GROUP BY o_custkey),
            m AS (SELECT o_custkey, s, e, CAST(unnest(generate_series(date_trunc('month', s), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS f FROM r)
       SELECT o_custkey, strftime(greatest(f, s), '%Y') AS year, strftime(greatest(f, s), '%m') AS month,
              strftime(greatest(f, s), '%Y%m%d') AS bdate,
              strftime(least(CAST(f + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), e), '%Y%m%d') AS edate FROM m""",
)
def _month_windows(spark, sf):
    return months_between(_order_ranges(spark, sf))


@register(
    "year_windows",
    """WITH r AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                  FROM orders GROUP BY o_custkey),
            m AS (SELECT o_custkey, s, e, CAST(unnest(generate_series(date_trunc('year', s), CAST(e AS TIMESTAMP), INTERVAL 1 YEAR)) AS DATE) AS f FROM r)
       SELECT o_custkey, strftime(greatest(f, s), '%Y') AS year, strftime(greatest(f, s), '%Y%m%d') AS bdate,
              strftime(least(CAST(f + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE), e), '%Y%m%d') AS edate FROM m""",
)
def _year_windows(spark, sf):
    return years_between(_order_ranges(spark, sf))


def _order_ranges(spark, sf) -> DataFrame:
    return (
        fx.table(spark, sf, "orders").groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("start_date"), F.max("o_orderdate").cast("date").alias("end_date"))
    )


@register(
    "gap_chunks",
    """WITH r AS (SELECT user_id, date_trunc('hour', min(ts)) AS s, date_trunc('hour', max(ts)) AS e FROM events GROUP BY user_id),
            c AS (SELECT user_id, e, unnest(generate_series(s, e, INTERVAL 6 HOUR)) AS f FROM r)
       SELECT user_id, f AS chunk_start_utc, least(f + INTERVAL 5 HOUR, e) AS chunk_end_utc FROM c""",
)
def _gap_chunks(spark, sf):
    spans = fx.table(spark, sf, "events").groupBy("user_id").agg(
        F.date_trunc("hour", F.min("ts")).alias("s"), F.date_trunc("hour", F.max("ts")).alias("e")
    )
    chunks = spans.select("user_id", F.explode(fn.hour_chunks(F.col("s"), F.col("e"), 6)).alias("c")).select("user_id", "c.*")
    return as_ntz(chunks, "chunk_start_utc", "chunk_end_utc")


# --- readers and normalisers -----------------------------------------------------


def _feed_map(**cells: Column) -> Column:
    return F.create_map(*[x for name, cell in cells.items() for x in (F.lit(name), cell)])


def _provisional_rows(spark, sf) -> DataFrame:
    raw = fx.raw_provisional(spark, sf)
    return raw.select(
        F.concat(F.lit("file-"), F.col("event_id").cast("string")).alias("object_key"),
        _feed_map(
            ParameterName=F.col("parameter_name"), AQSID=F.col("aqsid_raw"), ValidDate=F.col("valid_date"),
            ValidTime=F.col("valid_time"), GMTOffset=F.col("gmt_offset"), Value=F.col("value_text"),
            ReportingUnits=F.col("unit_text"),
        ).alias("raw_fields"),
    )


_NORMALISED = f"""
parsed AS (
  SELECT event_id, {_SITE} AS aqsid, {_POLLUTANT} AS pollutant_code, TRY_CAST(value_text AS DOUBLE) AS value_numeric,
         {_LOCAL} AS timestamp_local, {_UTC} AS timestamp_start_utc, {_DATE} AS changed,
         CASE WHEN trim(unit_text) = '' THEN 'unknown' ELSE unit_text END AS unit
  FROM raw_provisional),
normal AS (
  SELECT *, concat('airnow:', aqsid) AS location_id,
         concat('aqs_site:', substring(aqsid, 1, 2), ':', substring(aqsid, 3, 3), ':', substring(aqsid, 6, 4), '|', pollutant_code,
                '|concentration|hourly|', strftime(timestamp_start_utc, '%Y-%m-%dT%H:%M:%S'), '+00:00') AS natural_key
  FROM parsed
  WHERE pollutant_code IS NOT NULL AND value_numeric IS NOT NULL AND aqsid IS NOT NULL AND timestamp_start_utc IS NOT NULL)
"""
_IN_REGIONS = "(substring(aqsid, 1, 2) IN ('06', '09', '11') OR substring(aqsid, 1, 5) IN ('03003', '20001'))"
_TEST_REGIONS = [
    {"id": "west", "state_codes": ["6", "9"]},
    {"id": "east", "state_codes": ["11"], "state_county_pairs": [{"state_code": "3", "county_code": "3"}]},
    {"id": "isles", "state_county_pairs": [{"state_code": "20", "county_code": "001"}]},
]


@register(
    "normalize_provisional",
    with_views(
        "raw_provisional",
        f""", {_NORMALISED}
        SELECT concat('file-', CAST(event_id AS VARCHAR)) AS object_key, natural_key, location_id, aqsid, pollutant_code,
               value_numeric, unit, timestamp_start_utc, timestamp_start_utc + INTERVAL 1 HOUR AS timestamp_end_utc, timestamp_local,
               changed AS source_last_modified_date, 'AIRNOW' AS source_system, CAST(10 AS INTEGER) AS source_priority,
               sha256(concat('{{"natural_key":"', natural_key, '","qualifier_raw":null,"source_last_modified_date":"',
                             strftime(changed, '%Y-%m-%d'), '","unit":"', unit, '","value_numeric":',
                             CAST(value_numeric AS VARCHAR), '}}')) AS record_hash
        FROM normal WHERE {_IN_REGIONS}""",
    ),
)
def _normalize_provisional(spark, sf):
    observations = normalise.normalise_provisional(
        _provisional_rows(spark, sf), "airnow_hourly_file", config.pollutant_aliases(spark), config.region_config(spark, _TEST_REGIONS)
    )
    columns = observations.select(
        "object_key", "natural_key", "location_id", "aqsid", "pollutant_code", "value_numeric", "unit", "timestamp_start_utc",
        "timestamp_end_utc", "timestamp_local", "source_last_modified_date", "source_system", "source_priority", "record_hash",
    )
    return as_ntz(columns, "timestamp_start_utc", "timestamp_end_utc", "timestamp_local")


@register(
    "region_filter",
    with_views("raw_provisional", f", {_NORMALISED} SELECT event_id, aqsid FROM parsed WHERE {_IN_REGIONS}"),
)
def _region_filter(spark, sf):
    sites = fx.raw_provisional(spark, sf).select("event_id", fn.normalize_site_id(F.col("aqsid_raw")).alias("aqsid"))
    flagged = normalise.with_region_flag(sites, "aqsid", config.region_config(spark, _TEST_REGIONS))
    return flagged.where("in_region").select("event_id", "aqsid")


_STATION = {
    "state": fx._sql_code("s_nationkey", 2), "county": fx._sql_code("s_suppkey % 5", 3), "site": fx._sql_code("s_suppkey", 4),
}


@register(
    "normalize_authoritative",
    f"""WITH r AS (
          SELECT l_orderkey, l_partkey, p_type, {_STATION['state']} AS st,
                 CASE WHEN l_linenumber = 2 THEN '0na' ELSE {_STATION['county']} END AS co, {_STATION['site']} AS si,
                 l_linenumber, l_shipdate, CASE WHEN l_discount = 0 THEN l_quantity ELSE l_discount END AS v, l_returnflag
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
        SELECT concat(CAST(l_orderkey AS VARCHAR), '/', CAST(l_partkey AS VARCHAR)) AS object_key,
               concat('aqs_site:', st, ':', co, ':', si, '|', p_type, '|concentration|daily|',
                      strftime(l_shipdate, '%Y-%m-%dT00:00:00+00:00')) AS natural_key,
               concat('aqs:', st, ':', co, ':', si, ':', CASE WHEN l_linenumber = 1 THEN 'na' ELSE CAST(l_linenumber AS VARCHAR) END) AS location_id,
               concat(st, co, si) AS aqsid, p_type AS pollutant_code, v AS value_numeric,
               CASE WHEN l_returnflag = 'R' THEN concat('unit of ', p_type) ELSE 'ug/m3' END AS unit,
               l_shipdate AS timestamp_start_utc, l_shipdate + INTERVAL 1 DAY AS timestamp_end_utc,
               l_shipdate + INTERVAL 90 MINUTE AS timestamp_local, CAST(l_shipdate AS DATE) AS source_last_modified_date
        FROM r""",
)
def _normalize_authoritative(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    joined = lines.join(fx.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).join(
        fx.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    day = F.date_format("l_shipdate", "yyyy-M-d")
    rows = joined.select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("object_key"),
        F.create_map(F.lit("part"), F.col("p_type")).alias("raw_fields"),
        F.col("p_type").alias("parameter_code"),
        F.when(F.col("l_discount") != 0, F.col("l_discount").cast("string")).otherwise("").alias("arithmetic_mean"),
        F.col("l_quantity").cast("string").alias("first_max_value"),
        F.col("s_nationkey").cast("string").alias("state_code"),
        F.when(F.col("l_linenumber") != 2, (F.col("s_suppkey") % 5).cast("string")).otherwise(" ").alias("county_code"),
        F.col("s_suppkey").cast("string").alias("site_number"),
        F.when(F.col("l_linenumber") != 1, F.col("l_linenumber").cast("string")).alias("poc"),
        day.alias("date_local"),
        F.lit("1:30").alias("time_local"),
        F.when(F.col("l_returnflag") != "R", "ug/m3").alias("units_of_measure"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date_of_last_change"),
    )
    units = fx.pollutant(spark, sf).withColumn("default_unit", F.concat(F.lit("unit of "), "pollutant_code"))
    observations = normalise.normalise_authoritative(rows, "aqs_daily", units)
    columns = observations.select(
        "object_key", "natural_key", "location_id", "aqsid", "pollutant_code", "value_numeric", "unit", "timestamp_start_utc",
        "timestamp_end_utc", "timestamp_local", "source_last_modified_date",
    )
    return as_ntz(columns, "timestamp_start_utc", "timestamp_end_utc", "timestamp_local")


@register(
    "hourly_lines",
    with_views(
        "raw_provisional",
        """SELECT CASE WHEN event_id % 2 = 0 THEN 'piped' ELSE 'comma' END AS file_kind, parameter_name, aqsid_raw AS site,
                  valid_date, value_text,
                  CASE WHEN event_id % 2 = 0 THEN NULL ELSE concat('a, "b" ', CAST(event_id AS VARCHAR)) END AS extra, event_id
           FROM raw_provisional""",
    ),
)
def _hourly_lines(spark, sf):
    # raw feed rows as lines of files per day: half piped with a header, half
    # comma separated without one, with a quoted surplus cell
    raw = fx.raw_provisional(spark, sf)
    piped = F.col("event_id") % 2 == 0
    cells = [F.coalesce(F.col(c), F.lit("")) for c in ("valid_date", "valid_time", "aqsid_raw")]
    tail = [F.col("parameter_name"), F.col("event_id").cast("string"), F.col("value_text"), F.lit("agency")]
    line = F.when(piped, F.concat_ws("|", *cells, F.lit("name"), F.lit("0"), *tail)).otherwise(
        F.concat_ws(
            ",", *cells, F.lit("name"), F.lit("0"), *tail,
            F.concat(F.lit('"a, ""b"" '), F.col("event_id").cast("string"), F.lit('"')),
        )
    )
    kind = F.when(piped, "piped").otherwise("comma")
    lines = raw.select(
        F.concat_ws("/", kind, F.date_format(fn.parse_feed_date(F.col("valid_date")), "yyyyMMdd")).alias("object_key"),
        F.lit(0).cast("bigint").alias("block_start"), F.col("event_id").alias("line_id"), line.alias("line"),
    )
    header = "ValidDate|ValidTime|AQSID|SiteName|GMTOffset|ParameterName|ReportingUnits|Value|DataSource"
    headers = (
        lines.where(F.col("object_key").startswith("piped")).select("object_key").distinct()
        .select("object_key", F.lit(0).cast("bigint").alias("block_start"), F.lit(-1).cast("bigint").alias("line_id"), F.lit(header).alias("line"))
    )
    parsed = parse_hourly_lines(lines.unionByName(headers))
    cell = F.col("raw_fields")
    return parsed.select(
        F.split_part("object_key", F.lit("/"), F.lit(1)).alias("file_kind"), cell["ParameterName"].alias("parameter_name"),
        cell["AQSID"].alias("site"), cell["ValidDate"].alias("valid_date"), cell["Value"].alias("value_text"),
        cell["extra_9"].alias("extra"), cell["ReportingUnits"].cast("bigint").alias("event_id"),
    )


@register(
    "quoted_lines",
    with_views(
        "raw_provisional",
        """SELECT aqsid_raw AS site, concat('Site "', parameter_name, '"', chr(10), 'row, ', CAST(event_id AS VARCHAR)) AS site_name,
                  value_text, event_id FROM raw_provisional""",
    ),
)
def _quoted_lines(spark, sf):
    # raw feed rows as records of two lines each, in files per day; blocks end inside quoted cells
    raw = fx.raw_provisional(spark, sf)
    cells = [F.coalesce(F.col(c), F.lit("")) for c in ("valid_date", "valid_time", "aqsid_raw")]
    name = F.concat(F.lit('"Site ""'), "parameter_name", F.lit('""\nrow, '), F.col("event_id").cast("string"), F.lit('"'))
    record = F.concat_ws(",", *cells, name, F.lit("0"), "parameter_name", F.col("event_id").cast("string"), "value_text")
    lines = raw.select(
        F.date_format(fn.parse_feed_date(F.col("valid_date")), "yyyyMMdd").alias("object_key"), "event_id",
        F.posexplode(F.split(record, "\n")).alias("part", "line"),
    )
    number = F.col("event_id") * 2 + F.col("part")
    lines = lines.select("object_key", (F.floor((number + 1) / 4001) * 4001).alias("block_start"), number.alias("line_id"), "line")
    cell = F.col("raw_fields")
    return parse_hourly_lines(lines).select(
        cell["AQSID"].alias("site"), cell["SiteName"].alias("site_name"), cell["Value"].alias("value_text"),
        cell["ReportingUnits"].cast("bigint").alias("event_id"),
    )


def _order_documents(spark, sf, lists_only: bool = False) -> DataFrame:
    """One JSON document per order, its lines (at most a handful) as rows."""
    item = F.struct(
        F.col("l_partkey").cast("string").alias("parameter_code"), F.col("l_discount").alias("arithmetic_mean"),
        F.col("l_tax").alias("first_max_value"), F.col("l_quantity").alias("aqi"), F.col("l_suppkey").alias("poc"),
        F.col("l_linenumber").alias("line"),
    )
    orders = fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("rows"))
    enveloped = F.when(
        F.size("rows") > 2, F.to_json(F.struct(F.lit("ok").alias("Header"), F.col("rows").alias("Data")))
    ).otherwise(F.to_json(F.struct(F.col("rows").alias("body"))))
    listed = F.lit(True) if lists_only else F.size("rows") > 4
    text = F.when(listed, F.to_json("rows")).otherwise(enveloped)
    return orders.select(F.col("l_orderkey").cast("string").alias("object_key"), F.parse_json(text).alias("doc"))


@register(
    "authoritative_documents",
    """SELECT CAST(l_orderkey AS VARCHAR) AS object_key, CAST(l_partkey AS VARCHAR) AS parameter_code,
              CAST(l_suppkey AS VARCHAR) AS poc, l_linenumber AS line,
              CASE WHEN l_discount <> 0 THEN l_discount WHEN l_tax <> 0 THEN l_tax ELSE l_quantity END AS value_numeric
       FROM lineitem""",
)
def _authoritative_documents(spark, sf):
    rows = authoritative_rows(_order_documents(spark, sf))
    value = fn.parse_number(F.coalesce(fn.non_empty(F.col("arithmetic_mean")), fn.non_empty(F.col("first_max_value")), F.col("aqi")))
    return rows.select(
        "object_key", "parameter_code", "poc", F.col("raw_fields")["line"].cast("int").alias("line"), value.alias("value_numeric")
    )


@register(
    "gap_fill_documents",
    """SELECT CAST(l_orderkey AS VARCHAR) AS object_key, l_linenumber AS line, CAST(l_partkey AS VARCHAR) AS part
       FROM lineitem""",
)
def _gap_fill_documents(spark, sf):
    rows = gap_fill_rows(_order_documents(spark, sf, lists_only=True))
    cell = F.col("raw_fields")
    return rows.select("object_key", cell["line"].cast("int").alias("line"), cell["parameter_code"].alias("part"))


# --- validation ------------------------------------------------------------------


def _staged_text(spark, sf) -> DataFrame:
    """History rows as staged text, some of them damaged by the size of their value."""
    value, quantity = F.col("value_numeric"), F.col("value_numeric").cast("int")
    return evaluated(
        fx.history(spark, sf, False),
        "record_hash",
        F.when(quantity == 1, "").otherwise(F.col("natural_key")).alias("natural_key"),
        "location_id", "pollutant_code", "metric_type",
        F.when(quantity == 2, "1.5d").otherwise(value.cast("string")).alias("value_numeric"),
        F.when(quantity != 3, F.col("unit")).alias("unit"),
        "data_granularity",
        F.when(quantity == 4, "yesterday").otherwise(fn.iso_text(F.col("timestamp_start_utc"))).alias("timestamp_start_utc"),
        F.when(quantity == 5, "OTHER").otherwise(F.col("source_system")).alias("source_system"),
        "source_dataset",
        F.when(quantity == 6, "high").otherwise(F.col("source_priority").cast("string")).alias("source_priority"),
        F.when(quantity == 7, "draft").otherwise(F.col("data_status")).alias("data_status"),
        F.concat(*[fn.location_part(F.col("location_id"), i) for i in (2, 3, 4)]).alias("aqsid"),
    )


_STATUS = """
checked AS (
  SELECT h.record_hash, CASE WHEN CAST(h.value_numeric AS INTEGER) BETWEEN 1 AND 7 THEN 'rejected'
                WHEN h.source_system = 'AIRNOW' AND length(id) >= 9
                     AND substring(right(id, 9), 1, 2) IN (SELECT state_code FROM regions) THEN 'valid'
                WHEN h.source_system = 'AIRNOW' THEN 'region_filtered' ELSE 'valid' END AS status
  FROM (SELECT *, concat(split_part(location_id, ':', 2), split_part(location_id, ':', 3), split_part(location_id, ':', 4)) AS id
        FROM history) h)
"""
_ASIA = """regions AS (SELECT CASE WHEN n_nationkey < 10 THEN concat('0', CAST(n_nationkey AS VARCHAR)) ELSE CAST(n_nationkey AS VARCHAR) END
             AS state_code FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))"""


def _validated(spark, sf) -> DataFrame:
    regions = region_states(spark, sf).where(F.col("region_id").isin("ASIA", "EUROPE"))
    return validate.validated(_staged_text(spark, sf), regions)


@register("validate_rows", with_views("history", f", {_ASIA}, {_STATUS} SELECT record_hash, status FROM checked"))
def _validate_rows(spark, sf):
    return _validated(spark, sf).select("record_hash", "status")


@register(
    "validation_counts",
    with_views(
        "history",
        f""", {_ASIA}, {_STATUS} SELECT count(*) FILTER (WHERE status = 'valid') AS valid_rows,
               count(*) FILTER (WHERE status = 'rejected') AS rejected_rows,
               count(*) FILTER (WHERE status = 'region_filtered') AS region_filtered_rows FROM checked""",
    ),
)
def _validation_counts(spark, sf):
    return validate.status_counts(_validated(spark, sf))


@register(
    "dq_issues",
    with_views(
        "history",
        f""", {_ASIA}, {_STATUS}
        SELECT 'normalize_payload_invalid' AS issue_type, CAST(NULL AS VARCHAR) AS natural_key,
               concat('{{"rejected_rows":', CAST(count(*) AS VARCHAR), '}}') AS issue_detail
        FROM checked WHERE status = 'rejected' HAVING count(*) > 0
        UNION ALL
        SELECT 'airnow_region_filtered', NULL, concat('{{"filtered_rows":', CAST(count(*) AS VARCHAR), '}}')
        FROM checked WHERE status = 'region_filtered' HAVING count(*) > 0""",
    ),
)
def _dq_issues(spark, sf):
    return ledger.load_issues(validate.status_counts(_validated(spark, sf)))


# --- landing -----------------------------------------------------------------------

_DOC_AT = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 61))"


def _landed_documents(spark, sf) -> DataFrame:
    seconds = F.make_dt_interval(secs=(F.col("doc_id") * 61).cast("decimal(18,6)"))
    return fx.table(spark, sf, "documents").select(
        "doc_id", "source", (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + seconds).alias("extracted_at"),
        landing.content_hash(F.col("text")).alias("content_sha256"),
    )


@register(
    "landing_object_keys",
    f"""SELECT doc_id, sha256(text) AS content_sha256,
               concat('aqs/daily/year=', strftime({_DOC_AT}, '%Y'), '/month=', strftime({_DOC_AT}, '%m'), '/day=', strftime({_DOC_AT}, '%d'),
                      '/', strftime({_DOC_AT}, '%Y%m%dT%H%M%SZ'), '_', substring(sha256(text), 1, 12), '.json') AS object_key,
               concat('airnow/hourly/year=', strftime({_DOC_AT}, '%Y'), '/month=', strftime({_DOC_AT}, '%m'), '/day=', strftime({_DOC_AT}, '%d'),
                      '/HourlyData_', strftime({_DOC_AT}, '%Y%m%d%H'), '_', substring(sha256(text), 1, 12), '.dat') AS hourly_key,
               strftime({_DOC_AT}, '%Y-%m') AS landed_month
        FROM documents""",
)
def _landing_object_keys(spark, sf):
    at, sha = F.col("extracted_at"), F.col("content_sha256")
    keyed = _landed_documents(spark, sf).select(
        "doc_id", "content_sha256",
        landing.object_key("aqs_daily_json", at, sha).alias("object_key"),
        landing.hourly_object_key(at, landing.hourly_file_name(at), sha).alias("hourly_key"),
    )
    return keyed.withColumn("landed_month", landed_month(F.col("object_key")))


@register(
    "canonical_json",
    """SELECT o_orderkey, sha256(concat('{"o_custkey":', CAST(o_custkey AS VARCHAR), ',"o_orderkey":', CAST(o_orderkey AS VARCHAR),
                  ',"o_orderstatus":"', o_orderstatus, '","z":null}')) AS content_sha256 FROM orders""",
)
def _canonical_json(spark, sf):
    body = landing.canonical_json(
        F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderstatus"), F.lit(None).cast("string").alias("z")
    )
    return fx.table(spark, sf, "orders").select("o_orderkey", landing.content_hash(body).alias("content_sha256"))


def _manifest(spark, sf) -> DataFrame:
    docs = _landed_documents(spark, sf)
    return docs.select(
        F.col("source").alias("dataset"), F.substring("content_sha256", 1, 2).alias("object_key"),
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("source_url"), "content_sha256", "extracted_at",
    )


_MANIFEST_SQL = f"""manifest AS (SELECT source AS dataset, substring(sha256(text), 1, 2) AS object_key,
       concat('doc:', CAST(doc_id AS VARCHAR)) AS source_url, sha256(text) AS content_sha256, {_DOC_AT} AS extracted_at FROM documents)"""


@register(
    "manifest_upsert",
    f"""WITH {_MANIFEST_SQL}
        SELECT dataset, object_key, source_url, content_sha256, extracted_at FROM (
          SELECT *, row_number() OVER (PARTITION BY dataset, object_key ORDER BY extracted_at DESC, content_sha256 DESC) AS pos
          FROM manifest) WHERE pos = 1""",
)
def _manifest_upsert(spark, sf):
    rows = _manifest(spark, sf)
    middle = F.lit(datetime(2024, 1, 1, 6)).cast("timestamp_ntz")
    first = landing.upsert_manifest(rows.limit(0), rows.where(F.col("extracted_at") < middle))
    return landing.upsert_manifest(first, rows.where(F.col("extracted_at") >= middle))


@register(
    "landed_manifest",
    f"""SELECT 'aqs_daily_json' AS dataset, content_sha256,
               concat('aqs/daily/year=', strftime(landed_at, '%Y'), '/month=', strftime(landed_at, '%m'), '/day=', strftime(landed_at, '%d'),
                      '/', strftime(landed_at, '%Y%m%dT%H%M%SZ'), '_', substring(content_sha256, 1, 12), '.json') AS object_key
        FROM (SELECT DISTINCT sha256(text) AS content_sha256, date_trunc('day', {_DOC_AT}) AS landed_at FROM documents WHERE text IS NOT NULL)""",
)
def _landed_manifest(spark, sf):
    # one landing a day: equal texts of a day are one object
    at = F.date_trunc("day", F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(secs=(F.col("doc_id") * 61).cast("decimal(18,6)")))
    responses = fx.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("body"), F.lit("http://example.org").alias("source_url"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
    )
    landed = landing.landed_objects("aqs_daily_json", responses, at)
    return landing.current_manifest(landed.drop("body")).select("dataset", "object_key", "content_sha256")


@register(
    "gap_issues",
    """SELECT CASE event_type WHEN 'error' THEN 'airnow_gap_request_failed' ELSE 'airnow_gap_empty_response' END AS issue_type,
              concat('{', CASE event_type WHEN 'error' THEN '"error":"timeout",' ELSE '' END, '"params":"user=', CAST(user_id AS VARCHAR), '"}')
                AS issue_detail
       FROM events WHERE event_type = 'error' OR event_id % 3 = 0""",
)
def _gap_issues(spark, sf):
    failed = F.col("event_type") == "error"
    responses = fx.table(spark, sf, "events").select(
        F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("params"), F.when(failed, "timeout").alias("error"),
        F.when(~failed, F.col("event_id") % 3).alias("row_count"),
    )
    return ledger.gap_response_issues(responses).select("issue_type", "issue_detail")


@register(
    "newest_manifests",
    f"""WITH {_MANIFEST_SQL} SELECT * FROM manifest WHERE dataset = (SELECT max(dataset) FROM manifest)
        ORDER BY extracted_at DESC NULLS FIRST, object_key LIMIT 50""",
)
def _newest_manifests(spark, sf):
    rows = _manifest(spark, sf)
    last = rows.agg(F.max("dataset")).scalar()
    return landing.newest_manifests(rows.withColumn("dataset", F.when(F.col("dataset") == last, "chosen")), "chosen", 50).withColumn(
        "dataset", last
    )


@register(
    "unstaged_manifests",
    f"""WITH {_MANIFEST_SQL}, staged AS (
             SELECT substring(sha256(text), 1, 2) AS object_key, max({_DOC_AT}) AS staged_at FROM documents WHERE doc_id % 3 = 0 GROUP BY 1)
        SELECT m.* FROM manifest m WHERE m.dataset = (SELECT min(dataset) FROM manifest) AND NOT EXISTS (
          SELECT 1 FROM staged s WHERE s.object_key = m.object_key AND s.staged_at >= m.extracted_at)""",
)
def _unstaged_manifests(spark, sf):
    rows = _manifest(spark, sf)
    first = rows.agg(F.min("dataset")).scalar()
    thirds = rows.where(F.substring("source_url", 5, 20).cast("bigint") % 3 == 0)
    staging = thirds.select("object_key", F.col("extracted_at").alias("ingested_at"))
    chosen = rows.withColumn("dataset", F.when(F.col("dataset") == first, "chosen"))
    return landing.unstaged_manifests(chosen, staging, "chosen").withColumn("dataset", first)


@register(
    "row_lineage_hashes",
    """SELECT event_id, sha256(concat('{"dataset":"events","object_key":"', CAST(user_id AS VARCHAR), '","source_row":{"kind":"',
              event_type, '","user":"', CAST(user_id AS VARCHAR), '"}}')) AS source_row_hash FROM events""",
)
def _row_lineage_hashes(spark, sf):
    user = F.col("user_id").cast("string")
    fields = F.create_map(F.lit("user"), user, F.lit("kind"), F.col("event_type"))
    return fx.table(spark, sf, "events").select(
        "event_id", fn.row_lineage_hash(user, F.lit("events"), fields).alias("source_row_hash")
    )


_HOURS_SQL = """
spine AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS hour_start_utc),
expected AS (SELECT hour_start_utc, concat('HourlyData_', strftime(hour_start_utc, '%Y%m%d%H'), '.dat') AS file_name FROM spine),
listing AS (
  SELECT concat('HourlyData_', strftime(ts, '%Y%m%d%H'), '.dat') AS file_name,
         CAST(CASE WHEN min(event_id) % 7 = 0 THEN 404 WHEN min(event_id) % 11 = 0 THEN 500 ELSE 200 END AS INTEGER) AS http_status,
         CASE WHEN min(event_id) % 5 = 0 THEN 0 ELSE count(*) END AS content_length,
         sha256(CAST(count(*) AS VARCHAR)) AS content_sha256
  FROM events GROUP BY ALL),
landed AS (
  SELECT concat('HourlyData_', strftime(ts, '%Y%m%d%H'), '.dat') AS file_name, sha256(CAST(count(*) AS VARCHAR)) AS content_sha256,
         max(ts) AS extracted_at FROM events WHERE event_type <> 'error' GROUP BY file_name
  UNION ALL
  SELECT concat('HourlyData_', strftime(ts, '%Y%m%d%H'), '.dat'), 'older', min(ts) - INTERVAL 1 DAY FROM events GROUP BY ALL),
previous AS (SELECT file_name, content_sha256 AS previous_sha256 FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY extracted_at DESC, content_sha256 DESC) AS pos FROM landed) WHERE pos = 1),
status AS (
  SELECT e.hour_start_utc, e.file_name, l.http_status, l.content_sha256,
         CASE WHEN l.http_status IS NULL THEN 'failed' WHEN l.http_status = 404 THEN 'missing' WHEN l.http_status <> 200 THEN 'http_error'
              WHEN coalesce(l.content_length, 0) = 0 THEN 'empty' WHEN l.content_sha256 = p.previous_sha256 THEN 'no_update'
              ELSE 'written' END AS status
  FROM expected e LEFT JOIN listing l USING (file_name) LEFT JOIN previous p USING (file_name))
"""


def _hour_files(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(listing of fetched files, landing log) per hour of events."""
    events = fx.table(spark, sf, "events").withColumn("file_name", landing.hourly_file_name(F.col("ts")))
    first = F.min("event_id")
    size = F.count(F.lit(1))
    listing = events.groupBy("file_name").agg(
        F.when(first % 7 == 0, 404).when(first % 11 == 0, 500).otherwise(200).alias("http_status"),
        F.when(first % 5 == 0, 0).otherwise(size).alias("content_length"),
        landing.content_hash(size.cast("string")).alias("content_sha256"),
    )
    landed = events.where("event_type <> 'error'").groupBy("file_name").agg(
        landing.content_hash(size.cast("string")).alias("content_sha256"), F.max("ts").alias("extracted_at")
    )
    older = events.groupBy("file_name").agg(
        F.lit("older").alias("content_sha256"), (F.min("ts") - F.expr("interval 1 day")).alias("extracted_at")
    )
    return listing, landed.unionByName(older)


def _hot_status(spark, sf) -> DataFrame:
    listing, landed = _hour_files(spark, sf)
    spine = landing.expected_hours(spark, datetime(2024, 1, 31), 720)
    return landing.hot_window_status(spine, listing, landed)


@register("hot_window_status", f"WITH {_HOURS_SQL} SELECT * FROM status")
def _hot_window_status(spark, sf):
    return as_ntz(_hot_status(spark, sf), "hour_start_utc")


@register(
    "latest_completed_hour",
    f"""WITH {_HOURS_SQL} SELECT max(hour_start_utc) FILTER (WHERE status NOT IN ('failed', 'http_error')) AS latest_completed_hour_utc
        FROM status""",
)
def _latest_completed_hour(spark, sf):
    return as_ntz(landing.latest_completed_hour(_hot_status(spark, sf)), "latest_completed_hour_utc")


@register(
    "hot_window_issues",
    f"""WITH {_HOURS_SQL} SELECT concat('airnow_hourly_', CASE status WHEN 'failed' THEN 'request_failed' WHEN 'missing' THEN 'missing_file'
              WHEN 'empty' THEN 'empty_file' ELSE status END) AS issue_type, count(*) AS issues
        FROM status WHERE status <> 'written' GROUP BY ALL""",
)
def _hot_window_issues(spark, sf):
    issues = landing.hour_issues(_hot_status(spark, sf), "https://example.org/files")
    return issues.groupBy("issue_type").agg(F.count("issue_detail").alias("issues"))


@register("latest_file_hashes", f"WITH {_HOURS_SQL} SELECT file_name, previous_sha256 FROM previous")
def _latest_file_hashes(spark, sf):
    return landing.latest_file_hashes(_hour_files(spark, sf)[1])


@register(
    "changed_files",
    f"""WITH {_HOURS_SQL} SELECT l.file_name, l.content_sha256 FROM listing l LEFT JOIN previous p USING (file_name)
        WHERE l.content_sha256 IS DISTINCT FROM p.previous_sha256""",
)
def _changed_files(spark, sf):
    listing, landed = _hour_files(spark, sf)
    return landing.changed_files(listing, landed).select("file_name", "content_sha256")


# --- ledger ---------------------------------------------------------------------------

_RUNS_SQL = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS dag_id, o_orderdate AS event_ts, 'running' AS status, 'started' AS message
  FROM orders
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), o_orderpriority, o_orderdate + to_days(l_linenumber),
         CASE l_linestatus WHEN 'F' THEN 'success' ELSE 'failed' END, repeat(concat(l_linestatus, CAST(l_linenumber AS VARCHAR)), 1500)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _run_events(spark, sf) -> DataFrame:
    orders, lines = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    started = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("dag_id"),
        F.col("o_orderdate").alias("event_ts"), F.lit("running").alias("status"), F.lit("started").alias("message"),
    )
    ended = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("dag_id"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.col("l_linenumber"))).alias("event_ts"),
        F.when(F.col("l_linestatus") == "F", "success").otherwise("failed").alias("status"),
        F.repeat(F.concat("l_linestatus", F.col("l_linenumber").cast("string")), F.lit(1500)).alias("message"),
    )
    return started.unionByName(ended)


@register(
    "run_ledger_state",
    f"""WITH {_RUNS_SQL}
        SELECT DISTINCT run_id, dag_id, event_ts, length(substring(max(message) OVER w, 1, 2000)) AS message_length
        FROM (SELECT *, max(event_ts) OVER (PARTITION BY run_id) AS last_ts FROM runs) WHERE event_ts = last_ts
        WINDOW w AS (PARTITION BY run_id)""",
)
def _run_ledger_state(spark, sf):
    states = ledger.run_states(_run_events(spark, sf))
    return states.select("run_id", "dag_id", "event_ts", F.length("message").cast("bigint").alias("message_length"))


_FRESH = f"""WITH {_RUNS_SQL} SELECT dag_id, run_id, ended_at FROM (
   SELECT dag_id, run_id, event_ts AS ended_at, row_number() OVER (PARTITION BY dag_id ORDER BY event_ts DESC, run_id DESC) AS pos
   FROM runs WHERE status = 'success' {{age}}) WHERE pos = 1"""


@register("latest_successes", _FRESH.format(age=""))
def _latest_successes(spark, sf):
    return ledger.latest_successes(_run_events(spark, sf).withColumnRenamed("event_ts", "ended_at"))


@register("freshness_check", _FRESH.format(age="AND event_ts >= TIMESTAMP '1999-01-02 00:00:00' - INTERVAL 720 HOUR"))
def _freshness_check(spark, sf):
    runs = _run_events(spark, sf).withColumnRenamed("event_ts", "ended_at")
    return ledger.latest_successes(runs, F.lit(datetime(1999, 1, 2)).cast("timestamp_ntz"), 720)


@register(
    "mart_row_counts",
    with_views(
        "cur location pollutant threshold",
        """, facts AS (
             SELECT {'l': location_id, 'p': pollutant_code} AS series, {'s': state_code, 'c': county_code, 'p': pollutant_code} AS region,
                    CAST(timestamp_start_utc AS DATE) AS day, value_numeric AS v, unit, state_code
             FROM cur NATURAL JOIN (SELECT location_id, state_code, county_code FROM location) WHERE data_granularity = 'daily'),
           numbered AS (
             SELECT region, v, row_number() OVER (PARTITION BY region ORDER BY day) AS nth
             FROM (SELECT region, day, sum(v) / count(*) AS v FROM facts GROUP BY ALL)),
           spread AS (
             SELECT any_value(d.v) AS v, avg(e.v) AS m, stddev_samp(e.v) AS s
             FROM numbered d JOIN numbered e ON e.region IS NOT DISTINCT FROM d.region AND e.nth BETWEEN d.nth - 30 AND d.nth - 1
             GROUP BY d.region, d.nth)
           SELECT unnest(['latest_station', 'daily_trend', 'monthly_trend', 'seasonal_trend', 'region_coverage']) AS mart,
                  unnest([count(DISTINCT series), count(DISTINCT {'x': series, 'd': day}),
                          count(DISTINCT {'x': series, 'd': strftime(day, '%Y-%m')}),
                          count(DISTINCT {'x': series, 'y': year(day), 'q': quarter(day)}),
                          count(DISTINCT {'x': region, 'd': day}) FILTER (WHERE state_code IS NOT NULL)]) AS row_count FROM facts
           UNION ALL SELECT 'exceedance_events', CAST(sum((SELECT count(*) FROM facts f WHERE f.series.p = t.pollutant_code
             AND f.unit = t.unit AND f.v > t.threshold_value)) AS BIGINT) FROM threshold t WHERE t.is_active
           UNION ALL SELECT 'anomaly_spikes', count(*) FROM spread WHERE s > 0 AND abs(v - m) >= 2.5 * s""",
    ),
)
def _mart_row_counts(spark, sf):
    return refresh.row_counts(refresh.all_marts(fx.tables(spark, sf, with_ingestion=True)))
