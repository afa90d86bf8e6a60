"""Merge, version, dimension and watermark queries with their SQL oracles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.catalog import fixtures as fx
from plumeline.catalog.fixtures import with_views
from plumeline.functions import zero_fill
from plumeline.operators import dimensions, merge, watermarks
from plumeline.plans.load import merge_batch
from plumeline.schemas import LOCATION, POLLUTANT, conform
from plumeline.sources.staging import staged_rows, union_feeds

QUERIES = {}
ORACLES = {}
LOADED_AT = datetime(2002, 1, 1)
AS_OF = datetime(2003, 1, 1)


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def as_ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _loaded_current(existing: DataFrame) -> DataFrame:
    """Current as the existing rows left it."""
    return merge.rebuild_current(existing, LOADED_AT)


def _batches_by_key(spark, sf, *shown: str) -> tuple[DataFrame, DataFrame]:
    """Existing and incoming rows, those of a key in one task; what merges compare, and the columns ``shown``."""
    existing, incoming = fx.stored_batches(spark, sf)
    read = (*merge.VERSION_KEYS, "source_priority", *shown)
    return (
        merge.by_key(existing.select(*read, "ingested_at")),
        merge.by_key(incoming.select(*read, "timestamp_start_utc", "source_last_modified_date")),
    )


# Ranked views shared by the oracles.
_CUR0 = """
cur0 AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY natural_key
    ORDER BY source_priority DESC, ingested_at DESC NULLS FIRST, record_hash DESC) AS pos FROM existing) WHERE pos = 1),
win AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY natural_key
    ORDER BY source_priority DESC, timestamp_start_utc DESC NULLS LAST, source_last_modified_date DESC NULLS LAST,
             record_hash DESC) AS pos FROM incoming) WHERE pos = 1),
merged AS (
  SELECT c.natural_key AS old_key, w.natural_key AS new_key,
         w.natural_key IS NOT NULL AND (c.natural_key IS NULL OR w.source_priority > c.source_priority
           OR (w.source_priority = c.source_priority AND w.record_hash <> c.record_hash)) AS takes,
         c.record_hash AS old_hash, w.record_hash AS new_hash, c.source_system AS old_source, w.source_system AS new_source,
         c.value_numeric AS old_value, w.value_numeric AS new_value, c.source_priority AS old_priority,
         w.source_priority AS new_priority
  FROM cur0 c FULL OUTER JOIN win w ON c.natural_key = w.natural_key),
cur1 AS (
  SELECT coalesce(new_key, old_key) AS natural_key, CASE WHEN takes THEN new_hash ELSE old_hash END AS record_hash,
         CASE WHEN takes THEN new_source ELSE old_source END AS source_system,
         CASE WHEN takes THEN new_value ELSE old_value END AS value_numeric,
         CASE WHEN takes THEN new_priority ELSE old_priority END AS source_priority,
         CASE WHEN takes THEN TIMESTAMP '2003-01-01 00:00:00' ELSE TIMESTAMP '2002-01-01 00:00:00' END AS updated_at
  FROM merged)
"""
# The same with current as a load left it that took the existing rows as one batch.
CURRENT_AFTER_BATCHES = _CUR0.replace(
    "ingested_at DESC NULLS FIRST, record_hash DESC) AS pos FROM existing",
    "timestamp_start_utc DESC NULLS LAST, source_last_modified_date DESC NULLS LAST,\n"
    "             record_hash DESC) AS pos FROM existing",
)
_KEPT = ("natural_key", "record_hash", "source_system", "value_numeric", "source_priority")
_KEPT_SQL = ", ".join(_KEPT)


@register(
    "staging_union_dedupe",
    with_views(
        "history",
        """, staged AS (
             SELECT natural_key, record_hash, value_numeric, source_dataset, ingested_at FROM history
             UNION ALL
             SELECT natural_key, record_hash, value_numeric, source_dataset,
                    ingested_at + CASE WHEN data_status = 'final' THEN INTERVAL 1 DAY ELSE INTERVAL '-1' DAY END FROM history)
           SELECT natural_key, record_hash, value_numeric, source_dataset, ingested_at FROM (
             SELECT *, row_number() OVER (PARTITION BY natural_key, record_hash ORDER BY ingested_at DESC NULLS FIRST) AS pos
             FROM staged) WHERE pos = 1""",
    ),
)
def _staging_union_dedupe(spark, sf):
    # every row delivered twice, final ones again a day later, others a day earlier
    rows = fx.stored_history(spark, sf)
    day = F.expr("interval 1 day")
    again = rows.withColumn(
        "ingested_at", F.when(F.col("data_status") == "final", F.col("ingested_at") + day).otherwise(F.col("ingested_at") - day)
    )
    feeds = [staged_rows(rows, [f"feed_{g}"]) for g in ("daily", "hourly", "sample")]
    kept = merge.latest_staged(union_feeds(*feeds, again))
    return kept.select("natural_key", "record_hash", "value_numeric", "source_dataset", "ingested_at")


@register(
    "batch_winner",
    with_views("existing incoming", f", {_CUR0} SELECT {_KEPT_SQL}, timestamp_start_utc FROM win"),
)
def _batch_winner(spark, sf):
    _, incoming = fx.split_batches(spark, sf)
    return merge.batch_winners(incoming).select(*_KEPT, "timestamp_start_utc")


@register("upsert_current", with_views("existing incoming", f", {_CUR0} SELECT {_KEPT_SQL}, updated_at FROM cur1"))
def _upsert_current(spark, sf):
    existing, incoming = fx.split_batches(spark, sf)
    merged = merge.upsert_current(_loaded_current(existing), incoming, AS_OF)
    return as_ntz(merged.select(*_KEPT, "updated_at"), "updated_at")


_REBUILT = """
rebuilt AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY natural_key
    ORDER BY source_priority DESC, ingested_at DESC NULLS FIRST, record_hash DESC) AS pos FROM history) WHERE pos = 1)
"""


@register("rebuild_current", with_views("history", f", {_REBUILT} SELECT {_KEPT_SQL} FROM rebuilt"))
def _rebuild_current(spark, sf):
    return merge.rebuild_current(fx.history(spark, sf), AS_OF).select(*_KEPT)


@register(
    "rebuild_keeps_unlisted_keys",
    with_views(
        "existing incoming",
        f""", {_CUR0}, fresh AS (SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY natural_key
                ORDER BY source_priority DESC, ingested_at DESC NULLS FIRST, record_hash DESC) AS pos FROM incoming) WHERE pos = 1)
            SELECT {_KEPT_SQL}, TIMESTAMP '2003-01-01 00:00:00' AS updated_at FROM fresh
            UNION ALL
            SELECT {_KEPT_SQL}, TIMESTAMP '2002-01-01 00:00:00' FROM cur0
            WHERE natural_key NOT IN (SELECT natural_key FROM fresh)""",
    ),
)
def _rebuild_keeps_unlisted_keys(spark, sf):
    existing, incoming = fx.stored_batches(spark, sf)
    rebuilt = merge.rebuild_current(incoming, AS_OF, _loaded_current(existing))
    return as_ntz(rebuilt.select(*_KEPT, "updated_at"), "updated_at")


@register(
    "history_append",
    with_views(
        "existing incoming",
        """SELECT natural_key, record_hash, source_system, value_numeric, ingested_at FROM incoming""",
    ),
)
def _history_append(spark, sf):
    # the whole table arrives; what is already in history is left out
    rows = fx.stored_history(spark, sf)
    existing, _ = fx.split_by_date(rows)
    added = merge.new_history_rows(existing, rows)
    return added.select("natural_key", "record_hash", "source_system", "value_numeric", "ingested_at")


@register(
    "current_version_flags",
    with_views(
        "history",
        f""", {_REBUILT}
        SELECT h.natural_key, h.record_hash, h.source_system, r.natural_key IS NOT NULL AS is_current_version
        FROM history h LEFT JOIN rebuilt r ON h.natural_key = r.natural_key AND h.record_hash = r.record_hash
             AND h.source_system = r.source_system""",
    ),
)
def _current_version_flags(spark, sf):
    rows = fx.history(spark, sf)
    flagged = merge.with_current_flags(rows, merge.rebuild_current(rows, AS_OF))
    return flagged.select("natural_key", "record_hash", "source_system", "is_current_version")


@register(
    "refresh_current_flags",
    with_views(
        "existing incoming",
        f""", {_CUR0},
        flagged AS (
          SELECT e.natural_key, e.record_hash, e.source_system, c.natural_key IS NOT NULL AS flag
          FROM existing e LEFT JOIN cur0 c ON e.natural_key = c.natural_key AND e.record_hash = c.record_hash
               AND e.source_system = c.source_system
          UNION ALL SELECT natural_key, record_hash, source_system, false FROM incoming)
        SELECT f.natural_key, f.record_hash, f.source_system,
               CASE WHEN f.natural_key IN (SELECT natural_key FROM incoming) THEN c.natural_key IS NOT NULL ELSE f.flag END
                 AS is_current_version
        FROM flagged f LEFT JOIN cur1 c ON f.natural_key = c.natural_key AND f.record_hash = c.record_hash
             AND f.source_system = c.source_system""",
    ),
)
def _refresh_current_flags(spark, sf):
    existing, incoming = _batches_by_key(spark, sf)
    before = _loaded_current(existing)
    stored = merge.with_current_flags(existing, before).drop("ingested_at").unionByName(
        incoming.withColumn("is_current_version", F.lit(False)).drop("timestamp_start_utc", "source_last_modified_date")
    )
    after = merge.upsert_current(before, incoming, AS_OF)
    flagged = merge.refresh_current_flags(stored, after, incoming)
    return flagged.select("natural_key", "record_hash", "source_system", "is_current_version")


@register(
    "revision_audit",
    with_views(
        "existing incoming",
        f""", {_CUR0}
        SELECT i.natural_key, c.value_numeric AS old_value, i.value_numeric AS new_value, c.record_hash AS old_hash,
               i.record_hash AS new_hash
        FROM incoming i JOIN cur0 c ON i.natural_key = c.natural_key
        WHERE c.source_system = 'AIRNOW' AND i.source_system = 'AIRNOW' AND c.source_priority = i.source_priority
          AND c.record_hash <> i.record_hash""",
    ),
)
def _revision_audit(spark, sf):
    existing, incoming = fx.split_batches(spark, sf)
    return merge.revision_audit(_loaded_current(existing), incoming)


@register(
    "load_batch",
    with_views(
        "existing incoming",
        f""", {_CUR0}
        SELECT 'current' AS target, natural_key, record_hash, value_numeric FROM cur1
        UNION ALL
        SELECT 'history', natural_key, record_hash, value_numeric FROM incoming
        WHERE concat(natural_key, '/', record_hash, '/', source_system) NOT IN (
          SELECT concat(natural_key, '/', record_hash, '/', source_system) FROM existing)
        UNION ALL
        SELECT 'audit', new_key, i.record_hash, i.value_numeric FROM (
          SELECT natural_key AS new_key, record_hash AS old_hash, source_priority AS rank FROM cur0 WHERE source_system = 'AIRNOW')
        JOIN incoming i ON i.natural_key = new_key
        WHERE i.source_system = 'AIRNOW' AND i.source_priority = rank AND i.record_hash <> old_hash""",
    ),
)
def _load_batch(spark, sf):
    # all that one load does to its three tables
    existing, incoming = _batches_by_key(spark, sf, "value_numeric")
    batch = merge_batch(_loaded_current(existing), existing, incoming, AS_OF)
    row = ["natural_key", "record_hash", "value_numeric"]
    revised = batch.audit.select("natural_key", F.col("new_hash").alias("record_hash"), F.col("new_value").alias("value_numeric"))
    tables = {"current": batch.current.select(*row), "history": batch.new_history.select(*row), "audit": revised}
    return union_feeds(*[df.select(F.lit(name).alias("target"), *row) for name, df in tables.items()])


@register(
    "insert_ignore",
    with_views(
        "existing incoming",
        """SELECT natural_key, min(record_hash) AS record_hash FROM incoming
           WHERE natural_key NOT IN (SELECT natural_key FROM existing) GROUP BY natural_key""",
    ),
)
def _insert_ignore(spark, sf):
    existing, incoming = fx.split_batches(spark, sf)
    new = merge.insert_ignore(existing, incoming, ["natural_key"], [F.col("record_hash").asc()])
    return new.select("natural_key", "record_hash")


@register(
    "key_granularity_mapping",
    with_views(
        "history",
        """, mapped AS (
             SELECT *, CASE WHEN data_granularity = 'sample'
                         THEN concat_ws('|', location_id, pollutant_code, metric_type, 'hourly', split_part(natural_key, '|', 5))
                         ELSE natural_key END AS merged_key FROM history)
           SELECT natural_key, record_hash, data_granularity FROM (
             SELECT merged_key AS natural_key, record_hash, data_granularity,
                    row_number() OVER (PARTITION BY merged_key ORDER BY source_priority DESC,
                      ingested_at DESC NULLS FIRST, record_hash DESC) AS pos FROM mapped) WHERE pos = 1""",
    ),
)
def _key_granularity_mapping(spark, sf):
    mapped = merge.map_key_granularity(fx.history(spark, sf), {"sample": "hourly"})
    return merge.rebuild_current(mapped, AS_OF).select("natural_key", "record_hash", "data_granularity")


# --- dimensions ----------------------------------------------------------------


@register(
    "dim_location_upsert",
    with_views(
        "history location",
        """, last AS (SELECT * FROM (
             SELECT location_id, record_hash, value_numeric,
                    row_number() OVER (PARTITION BY location_id ORDER BY ingested_at DESC NULLS LAST, record_hash DESC) AS pos
             FROM history) WHERE pos = 1)
           SELECT l.location_id, l.location_type, CASE WHEN d.location_id IS NULL THEN l.state_code
                    ELSE split_part(d.location_id, ':', 2) END AS state_code, l.county_code, l.site_number,
                  CASE WHEN d.location_id IS NULL THEN NULL ELSE '1' END AS poc,
                  coalesce(d.record_hash, l.site_name) AS site_name,
                  CASE WHEN d.location_id IS NULL THEN l.latitude ELSE d.value_numeric END AS latitude
           FROM location l LEFT JOIN last d ON l.location_id = d.location_id""",
    ),
)
def _dim_location_upsert(spark, sf):
    observed = fx.history(spark, sf).withColumn(
        "raw_fields", F.create_map(F.lit("site_name"), "record_hash", F.lit("latitude"), F.col("value_numeric").cast("string"))
    )
    existing = fx.location(spark, sf)
    after = dimensions.upsert_locations(conform(existing, LOCATION), observed)
    return after.select(
        "location_id", "location_type", "state_code", "county_code", "site_number", "poc", "site_name", "latitude"
    )


@register(
    "dim_pollutant_upsert",
    with_views(
        "history pollutant",
        """, config AS (SELECT DISTINCT p_brand AS code FROM part UNION SELECT 'PROMO'),
           seen AS (SELECT * FROM (
             SELECT pollutant_code, unit, source_system,
                    row_number() OVER (PARTITION BY pollutant_code ORDER BY ingested_at DESC NULLS LAST, record_hash DESC) AS pos
             FROM history) WHERE pos = 1)
           SELECT coalesce(c.code, s.pollutant_code) AS pollutant_code,
                  CASE WHEN c.code IS NULL THEN s.pollutant_code ELSE concat('configured ', c.code) END AS pollutant_name,
                  CASE WHEN c.code IS NULL THEN s.unit ELSE 'ppm' END AS default_unit,
                  concat('{"last_seen_source_system":"', coalesce(s.source_system, 'CONFIG'), '","source":"',
                         CASE WHEN s.pollutant_code IS NULL THEN 'config' ELSE 'normalized_observation' END, '"}') AS metadata
           FROM config c FULL OUTER JOIN seen s ON c.code = s.pollutant_code
           UNION ALL
           SELECT pollutant_code, pollutant_name, default_unit, NULL FROM pollutant
           WHERE pollutant_code NOT IN (SELECT code FROM config UNION SELECT pollutant_code FROM seen)""",
    ),
)
def _dim_pollutant_upsert(spark, sf):
    codes = fx.table(spark, sf, "part").select(F.col("p_brand").alias("pollutant_code"))
    codes = codes.unionByName(fx.pollutant(spark, sf).where("pollutant_code = 'PROMO'").select("pollutant_code")).distinct()
    config = codes.select(
        "pollutant_code",
        F.concat(F.lit("configured "), "pollutant_code").alias("pollutant_name"),
        F.lit("ppm").alias("default_unit"),
    )
    return dimensions.upsert_pollutants(conform(fx.pollutant(spark, sf), POLLUTANT), fx.history(spark, sf), config)


@register(
    "threshold_refresh",
    """WITH old AS (SELECT p_type AS pollutant_code, p_brand AS threshold_type, max(p_retailprice) AS threshold_value
                    FROM part WHERE p_size <= 30 GROUP BY ALL),
            cfg AS (SELECT p_type AS pollutant_code, p_brand AS threshold_type, min(p_retailprice) AS threshold_value
                    FROM part WHERE p_size > 20 GROUP BY ALL)
       SELECT coalesce(c.pollutant_code, o.pollutant_code) AS pollutant_code,
              coalesce(c.threshold_type, o.threshold_type) AS threshold_type,
              coalesce(c.threshold_value, o.threshold_value) AS threshold_value,
              CASE WHEN c.pollutant_code IS NULL THEN 'old' ELSE 'new' END AS unit, c.pollutant_code IS NOT NULL AS is_active
       FROM old o FULL OUTER JOIN cfg c ON o.pollutant_code = c.pollutant_code AND o.threshold_type = c.threshold_type""",
)
def _threshold_refresh(spark, sf):
    part = fx.table(spark, sf, "part")
    keys = [F.col("p_type").alias("pollutant_code"), F.col("p_brand").alias("threshold_type")]
    existing = (
        part.where("p_size <= 30").groupBy(*keys).agg(F.max("p_retailprice").alias("threshold_value"))
        .withColumns({"unit": F.lit("old"), "is_active": F.lit(True)})
    )
    config = (
        part.where("p_size > 20").groupBy(*keys).agg(F.min("p_retailprice").alias("threshold_value"))
        .withColumn("unit", F.lit("new"))
    )
    refreshed = dimensions.refresh_thresholds(existing, config, AS_OF)
    return refreshed.select("pollutant_code", "threshold_type", "threshold_value", "unit", "is_active")


@register(
    "location_parse",
    """SELECT concat('airnow:', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS location_id, 'site' AS location_type,
              'US' AS country_code, substring(lpad(CAST(user_id AS VARCHAR), 9, '0'), 1, 2) AS state_code,
              substring(lpad(CAST(user_id AS VARCHAR), 9, '0'), 3, 3) AS county_code,
              substring(lpad(CAST(user_id AS VARCHAR), 9, '0'), 6, 4) AS site_number, CAST(NULL AS VARCHAR) AS poc,
              lpad(CAST(user_id AS VARCHAR), 9, '0') AS aqsid, event_type AS site_name,
              CAST(value AS DOUBLE) AS latitude, event_id FROM events
       UNION ALL
       SELECT concat('aqs:na:', event_type, ':00na:NA'), 'site_monitor', 'US', NULL, event_type, '00na', NULL, NULL, event_type,
              CAST(value AS DOUBLE), event_id FROM events
       UNION ALL
       SELECT event_type, 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, event_id FROM events""",
)
def _location_parse(spark, sf):
    events = fx.table(spark, sf, "events")
    site = F.concat(F.lit("airnow:"), zero_fill(F.col("user_id").cast("string"), 9))
    monitor = F.concat(F.lit("aqs:na:"), "event_type", F.lit(":00na:NA"))
    names = F.create_map(
        F.lit("SiteName"), F.concat(F.lit(" "), "event_type"), F.lit("site_name"), "event_type",
        F.lit("latitude"), F.col("value").cast("string"),
    )
    rows = union_feeds(
        *[
            events.select("event_id", location.alias("location_id"), names.alias("raw_fields"))
            for location in (site, monitor, F.col("event_type"))
        ]
    )
    return dimensions.parse_locations(rows).select(
        "location_id", "location_type", "country_code", "state_code", "county_code", "site_number", "poc", "aqsid",
        "site_name", "latitude", "event_id",
    )


# --- watermarks ------------------------------------------------------------------

_REGIONS_SQL = f"""
regions AS (SELECT r_name AS region_id, {fx._sql_code('n_nationkey', 2)} AS state_code
            FROM nation JOIN region ON n_regionkey = r_regionkey)
"""
_TAILS_SQL = f"""
{_REGIONS_SQL},
tails AS (
  SELECT r.region_id, h.pollutant_code, max(h.timestamp_start_utc) AS tail
  FROM history h JOIN regions r ON split_part(h.location_id, ':', 2) = r.state_code
  WHERE h.source_system = 'AQS' GROUP BY ALL),
marks AS (
  SELECT 'AQS' AS source_name, concat('tail_max_ts_utc:', region_id, ':', pollutant_code) AS watermark_key, tail FROM tails
  UNION ALL SELECT 'AQS', 'tail_max_ts_utc:global', max(tail) FROM tails)
"""


def region_states(spark, sf) -> DataFrame:
    """Regions with their states: one state per nation."""
    nation, region = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("region_id"),
        zero_fill(F.col("n_nationkey").cast("string"), 2).alias("state_code"),
        F.lit(None).cast("string").alias("county_code"),
    )


def _tails(spark, sf) -> DataFrame:
    return watermarks.tail_watermarks(fx.history(spark, sf, False), region_states(spark, sf), fx.pollutant(spark, sf))


@register(
    "tail_watermarks",
    with_views(
        "history",
        f""", {_TAILS_SQL} SELECT source_name, watermark_key,
              concat(strftime(tail, '%Y-%m-%dT%H:%M:%S'), '+00:00') AS watermark_value FROM marks""",
    ),
)
def _tail_watermarks(spark, sf):
    return _tails(spark, sf)


@register(
    "batch_watermarks",
    with_views(
        "history",
        """SELECT 'AIRNOW' AS source_name, 'latest_completed_hour_utc' AS watermark_key,
                  concat(strftime(max(timestamp_start_utc), '%Y-%m-%dT%H:%M:%S'), '+00:00') AS watermark_value
           FROM history WHERE source_system = 'AIRNOW'
           UNION ALL SELECT 'AQS', 'latest_change_date', strftime(max(source_last_modified_date), '%Y%m%d')
           FROM history WHERE source_system = 'AQS'""",
    ),
)
def _batch_watermarks(spark, sf):
    return watermarks.batch_watermarks(fx.history(spark, sf, False))


def _mark_log(spark, sf) -> DataFrame:
    return fx.table(spark, sf, "events").select(
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("watermark_key"),
        zero_fill(F.col("event_id").cast("string"), 12).alias("watermark_value"),
        F.col("ts").alias("updated_at"),
    )


@register(
    "watermark_upsert",
    f"""WITH log AS (SELECT event_type AS source_name, concat('user:', CAST(user_id AS VARCHAR)) AS watermark_key,
                           {fx._sql_code('event_id', 12)} AS watermark_value, ts AS updated_at FROM events)
        SELECT source_name, watermark_key, watermark_value, updated_at FROM (
          SELECT *, row_number() OVER (PARTITION BY source_name, watermark_key
            ORDER BY updated_at DESC, watermark_value DESC) AS pos FROM log) WHERE pos = 1""",
)
def _watermark_upsert(spark, sf):
    log = _mark_log(spark, sf)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    existing = watermarks.latest_watermarks(log.where(F.col("updated_at") < middle))
    return watermarks.upsert_watermarks(existing, log.where(F.col("updated_at") >= middle))


_WINDOW_SQL = """SELECT date_trunc('hour', tail) + INTERVAL 1 HOUR AS start_utc, TIMESTAMP '2002-12-31 23:00:00' AS end_utc,
       tail AS aqs_tail_utc, date_trunc('hour', tail) + INTERVAL 1 HOUR > TIMESTAMP '2002-12-31 23:00:00' AS is_empty
FROM (SELECT max(tail) AS tail FROM tails)"""


@register("gap_window_from_watermark", with_views("history", f", {_TAILS_SQL} {_WINDOW_SQL}"))
def _gap_window_from_watermark(spark, sf):
    rows = fx.history(spark, sf, False)
    tail = watermarks.authoritative_tail(_tails(spark, sf), rows, rows)
    return as_ntz(watermarks.gap_window(tail, AS_OF), "start_utc", "end_utc", "aqs_tail_utc")


@register(
    "gap_chunks_from_facts",
    with_views(
        "history",
        """, w AS (SELECT date_trunc('hour', max(timestamp_start_utc)) + INTERVAL 1 HOUR AS s,
                         TIMESTAMP '2002-12-31 23:00:00' AS e FROM history WHERE source_system = 'AQS')
           SELECT chunk AS chunk_start_utc, least(chunk + INTERVAL 11 HOUR, e) AS chunk_end_utc
           FROM (SELECT unnest(generate_series(s, e, INTERVAL 12 HOUR)) AS chunk, e FROM w)""",
    ),
)
def _gap_chunks_from_facts(spark, sf):
    # no tail watermark is stored, so the tail comes from current and history
    rows = fx.history(spark, sf, False)
    marks = _mark_log(spark, sf)
    tail = watermarks.authoritative_tail(marks, rows, rows)
    chunks = watermarks.gap_chunks(watermarks.gap_window(tail, AS_OF), 12)
    return as_ntz(chunks, "chunk_start_utc", "chunk_end_utc")


@register(
    "reconcile_window_filter",
    with_views(
        "history",
        """, c AS (SELECT max(source_last_modified_date) - 30 AS checkpoint FROM history)
           SELECT natural_key, record_hash, source_last_modified_date FROM history, c
           WHERE source_last_modified_date >= checkpoint - 3 AND source_last_modified_date <= DATE '2003-01-01'""",
    ),
)
def _reconcile_window_filter(spark, sf):
    rows = fx.history(spark, sf, False)
    marks = rows.agg(F.date_format(F.date_sub(F.max("source_last_modified_date"), 30), "yyyyMMdd").alias("watermark_value"))
    marks = marks.select(
        F.lit("AQS").alias("source_name"), F.lit("reconcile_last_cedate").alias("watermark_key"), "watermark_value",
        F.lit(LOADED_AT).alias("updated_at"),
    )
    window = watermarks.change_window(marks, AS_OF, overlap_days=3)
    return watermarks.changed_within(rows, window).select("natural_key", "record_hash", "source_last_modified_date")
