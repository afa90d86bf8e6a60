"""Dimension upserts (SNK-5..7, NRM-13)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.merge import upsert_latest
from plumeline.operators.ranking import first_per_key
from plumeline.schemas import LOCATION, POLLUTANT, THRESHOLD, conform


def _recency() -> list[Column]:
    # "Last row wins" made explicit: newest ingestion, then largest hash.
    return [F.col("ingested_at").desc_nulls_last(), F.col("record_hash").desc_nulls_last()]


def _metadata(**entries: Column) -> Column:
    return F.to_json(F.struct(*[entries[k].alias(k) for k in sorted(entries)]))


def pollutant_rows(valid: DataFrame, config: DataFrame) -> DataFrame:
    """Pollutant rows of a batch: configured ones, overridden by observed ones;
    names and units come from configuration where it has them."""
    last_seen = first_per_key(
        valid.select("pollutant_code", "unit", "source_system", "ingested_at", "record_hash"),
        ["pollutant_code"],
        _recency(),
    )
    merged = config.alias("c").join(last_seen.alias("o"), "pollutant_code", "full_outer")
    observed = F.col("o.source_system").isNotNull()
    return merged.select(
        "pollutant_code",
        F.coalesce(fn.non_empty(F.col("c.pollutant_name")), F.col("pollutant_code")).alias("pollutant_name"),
        F.coalesce(fn.non_empty(F.col("c.default_unit")), F.col("o.unit"), F.lit("unknown")).alias("default_unit"),
        _metadata(
            source=F.when(observed, "normalized_observation").otherwise("config"),
            last_seen_source_system=F.coalesce(F.col("o.source_system"), F.lit("CONFIG")),
        ).alias("metadata"),
    )


def upsert_pollutants(existing: DataFrame, valid: DataFrame, config: DataFrame) -> DataFrame:
    """Pollutant dimension after a batch (SNK-5)."""
    return upsert_latest(existing, conform(pollutant_rows(valid, config), POLLUTANT), ["pollutant_code"])


def parse_locations(df: DataFrame) -> DataFrame:
    """Dimension columns from ``location_id`` and ``raw_fields`` (NRM-13)."""
    parts = [fn.location_part(F.col("location_id"), i) for i in range(1, 6)]
    monitor, site = parts[0] == "aqs", parts[0] == "airnow"

    def raw(*names: str) -> Column:
        return F.coalesce(*[fn.non_empty(F.col("raw_fields")[n]) for n in names])

    def either(of_monitor: Column, of_site: Column) -> Column:
        return F.when(monitor, of_monitor).when(site, of_site)

    nothing = F.lit(None).cast("string")
    site_id = fn.normalize_site_id(F.coalesce(parts[1], raw("AQSID", "aqsid")))
    return df.withColumns(
        {
            "location_type": F.when(monitor, "site_monitor").when(site, "site").otherwise("unknown"),
            "country_code": F.when(monitor | site, "US"),
            "state_code": either(fn.null_if_na(parts[1]), F.substring(site_id, 1, 2)),
            "county_code": either(fn.null_if_na(parts[2]), F.substring(site_id, 3, 3)),
            "site_number": either(fn.null_if_na(parts[3]), F.substring(site_id, 6, 4)),
            "poc": either(fn.null_if_na(parts[4]), nothing),
            "aqsid": either(fn.non_blank(F.col("raw_fields")["aqs_site_id"]), site_id),
            "site_name": fn.non_blank(either(raw("site_name"), raw("SiteName", "site name"))),
            "city_name": fn.non_blank(either(raw("city_name"), raw("ReportingArea", "reporting area"))),
            "timezone_name": fn.non_blank(either(raw("local_site_name"), nothing)),
            "timezone_offset_hours": fn.parse_number(either(nothing, raw("GMTOffset", "gmt offset"))),
            "latitude": fn.parse_number(either(raw("latitude"), raw("Latitude", "latitude"))),
            "longitude": fn.parse_number(either(raw("longitude"), raw("Longitude", "longitude"))),
        }
    )


def location_rows(valid: DataFrame) -> DataFrame:
    """One row per station of a batch, from its last observation."""
    last = first_per_key(
        valid.select("location_id", "raw_fields", "source_system", "ingested_at", "record_hash"),
        ["location_id"],
        _recency(),
    )
    return parse_locations(last).withColumn(
        "metadata",
        _metadata(
            source=F.lit("normalized_observation"),
            last_seen_source_system=F.col("source_system"),
            raw_location_fields=F.col("raw_fields"),
        ),
    )


def upsert_locations(existing: DataFrame, valid: DataFrame) -> DataFrame:
    """Location dimension after a batch (SNK-6)."""
    return upsert_latest(existing, conform(location_rows(valid), LOCATION), ["location_id"])


def refresh_thresholds(existing: DataFrame, config: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Threshold dimension after a load (SNK-7): all rows inactive, then the
    complete configured ones written as active.

    Configured rows without pollutant, type or unit, or with a value that is no
    number, are skipped.  Of repeated keys the highest ``position`` wins.
    """
    value = F.col("threshold_value")
    if dict(config.dtypes)["threshold_value"] == "string":
        value = fn.parse_number(value)
    keys = ["pollutant_code", "threshold_type"]
    cleaned = config.select(
        *[fn.non_blank(F.col(c)).alias(c) for c in ("pollutant_code", "threshold_type", "unit")],
        value.alias("threshold_value"),
        (F.col("position") if "position" in config.columns else F.lit(0)).alias("position"),
    ).dropna()
    configured = first_per_key(cleaned, keys, [F.col("position").desc(), F.col("threshold_value").desc()])
    columns = [f.name for f in THRESHOLD.fields]
    old = conform(existing, THRESHOLD).alias("old")
    new = configured.select(*keys, "threshold_value", "unit", F.lit(True).alias("listed")).alias("new")
    joined = old.join(new, keys, "full_outer")
    return joined.select(
        *keys,
        F.coalesce("new.threshold_value", "old.threshold_value").alias("threshold_value"),
        F.coalesce("new.unit", "old.unit").alias("unit"),
        F.coalesce("new.listed", F.lit(False)).alias("is_active"),
        F.when(F.col("new.listed"), _metadata(source=F.lit("config"))).otherwise(F.col("old.metadata")).alias("metadata"),
        fn.as_column(as_of).cast("timestamp").alias("updated_at"),
    ).select(*columns)

