"""Raw feed rows to canonical observations (NRM-1, NRM-2, NRM-15, JOIN-8, JOIN-9).

Input rows carry ``object_key`` and ``raw_fields`` and, optionally, columns
``meta_pollutant_code``, ``meta_state``, ``meta_county`` taken from the
manifest of the landed object.  Rows that cannot become an observation are
dropped, as in the feeds' rules; no UDFs, one projection per feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.ranking import evaluated
from plumeline.schemas import (
    AUTHORITATIVE,
    AUTHORITATIVE_FIELDS,
    METRIC,
    PRIORITY,
    PROVISIONAL,
    PROVISIONAL_ALIASES,
)
from plumeline.session import broadcast_if_small
from plumeline.sources.config import region_areas


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def normalise_authoritative(
    rows: DataFrame,
    dataset: str,
    pollutants: DataFrame,
    *,
    compat_none_text: bool = False,
) -> DataFrame:
    """Authoritative rows to observations (NRM-1): priority 100, ``final``.

    ``dataset`` is ``aqs_sample`` or ``aqs_daily``.  A JSON null in ``poc``,
    ``method_code`` or ``method_name`` is NULL here; ``compat_none_text`` gives
    the text ``None`` instead, as older loads stored it.
    """
    sample = dataset == "aqs_sample"
    raw = {name: _optional(rows, name) for name in AUTHORITATIVE_FIELDS}

    def nullable_text(name: str) -> Column:
        if not compat_none_text:
            return fn.non_blank(raw[name])
        explicit_null = F.map_contains_key("raw_fields", F.lit(name)) & F.col("raw_fields")[name].isNull()
        return fn.non_blank(F.when(explicit_null, F.lit("None")).otherwise(raw[name]))

    pollutant = fn.non_blank(
        F.coalesce(
            fn.non_empty(raw["parameter_code"]),
            fn.non_empty(raw["param"]),
            fn.non_empty(_optional(rows, "meta_pollutant_code")),
        )
    )
    if sample:
        value = fn.parse_number(raw["sample_measurement"])
    else:
        value = fn.parse_number(
            F.coalesce(fn.non_empty(raw["arithmetic_mean"]), fn.non_empty(raw["first_max_value"]), raw["aqi"])
        )
    state_text = F.coalesce(fn.non_empty(raw["state_code"]), _optional(rows, "meta_state"))
    county_text = F.coalesce(fn.non_empty(raw["county_code"]), _optional(rows, "meta_county"))
    gmt_start = fn.parse_date_time(raw["date_gmt"], raw["time_gmt"])
    local_start = fn.parse_date_time(raw["date_local"], raw["time_local"])

    parsed = evaluated(
        rows,
        "object_key",
        "raw_fields",
        pollutant.alias("pollutant_code"),
        value.alias("value_numeric"),
        fn.zero_fill_code(state_text, 2).alias("_state"),
        fn.zero_fill_code(county_text, 3).alias("_county"),
        fn.zero_fill_code(raw["site_number"], 4).alias("_site"),
        F.coalesce(nullable_text("poc"), F.lit("na")).alias("_poc"),
        F.coalesce(gmt_start, fn.parse_iso_date(raw["date_local"]).cast("timestamp")).alias("timestamp_start_utc"),
        local_start.alias("_local_start"),
        F.coalesce(
            fn.non_empty(raw["units_of_measure"]), fn.non_empty(raw["unit_of_measure"])
        ).alias("_unit"),
        fn.parse_iso_date(raw["date_of_last_change"]).alias("source_last_modified_date"),
        nullable_text("method_code").alias("method_code"),
        nullable_text("method_name").alias("method_name"),
        fn.non_blank(F.coalesce(fn.non_empty(raw["qualifier"]), raw["qualifiers"])).alias("qualifier_raw"),
    ).where(
        F.col("pollutant_code").isNotNull()
        & F.col("value_numeric").isNotNull()
        & F.col("timestamp_start_utc").isNotNull()
    )
    units = pollutants.select("pollutant_code", "default_unit")
    parsed = parsed.join(broadcast_if_small(units), "pollutant_code", "left")
    location = F.concat_ws(":", F.lit("aqs"), "_state", "_county", "_site", "_poc")
    identified = parsed.withColumns(
        {
            "timestamp_local": F.coalesce("_local_start", "timestamp_start_utc"),
            "location_id": location,
            "site_natural_location_id": fn.site_location_id(
                state_code=F.col("_state"), county_code=F.col("_county"), site_number=F.col("_site"), fallback=location
            ),
            "aqsid": F.concat("_state", "_county", "_site"),
            "unit": fn.strip(F.coalesce(F.col("_unit"), F.col("default_unit"), F.lit(""))),
            "timestamp_end_utc": F.lit(None).cast("timestamp")
            if sample
            else F.col("timestamp_start_utc") + F.expr("interval 1 day"),
        }
    )
    return _finish(
        identified,
        source_system=AUTHORITATIVE,
        dataset=dataset,
        granularity="sample" if sample else "daily",
        status="final",
        hash_fields=("natural_key", "value_numeric", "unit", "source_last_modified_date", "method_code", "qualifier_raw"),
    )


def normalise_provisional(
    rows: DataFrame,
    dataset: str,
    aliases: DataFrame,
    regions: DataFrame | None = None,
    *,
    granularity: str = "hourly",
) -> DataFrame:
    """Provisional rows to observations (NRM-2): priority 10, ``provisional``.

    Only ``raw_fields`` is read, by alias.  ``regions`` limits the sites; None
    or an empty table admits all.
    """

    def field(name: str) -> Column:
        return fn.first_non_blank(*[F.col("raw_fields")[alias] for alias in PROVISIONAL_ALIASES[name]])

    # Staged projections: a parsed value used several times is one column of an
    # earlier step, which the optimizer keeps apart instead of repeating it.
    texts = rows.select("object_key", "raw_fields", *[field(name).alias(f"_{name}") for name in PROVISIONAL_ALIASES])
    values = evaluated(
        texts,
        "object_key",
        "raw_fields",
        fn.pollutant_key(F.col("_parameter")).alias("alias_key"),
        fn.parse_number(F.col("_value")).alias("value_numeric"),
        fn.normalize_site_id(F.col("_site")).alias("aqsid"),
        fn.parse_utc_timestamp(F.col("_utc")).alias("_utc"),
        fn.local_timestamp(F.col("_date"), F.col("_time")).alias("_local"),
        fn.parse_offset_hours(F.col("_offset")).alias("_offset"),
        F.coalesce(F.col("_unit"), F.lit("unknown")).alias("unit"),
        fn.parse_feed_date(F.col("_changed")).alias("source_last_modified_date"),
        F.col("_agency").alias("qualifier_raw"),
    )
    parsed = values.where(
        F.col("value_numeric").isNotNull()
        & F.col("aqsid").isNotNull()
        & (F.col("_utc").isNotNull() | F.col("_local").isNotNull())
    ).withColumns(
        {
            "timestamp_start_utc": F.coalesce("_utc", fn.local_to_utc(F.col("_local"), F.col("_offset"))),
            "timestamp_local": F.coalesce("_utc", "_local"),
            "method_code": F.lit(None).cast("string"),
            "method_name": F.lit(None).cast("string"),
        }
    )
    known = parsed.join(broadcast_if_small(aliases), "alias_key")
    if regions is not None:
        known = with_region_flag(known, "aqsid", regions).where("in_region").drop("in_region")
    known = known.where(F.col("timestamp_start_utc").isNotNull())
    location = F.concat(F.lit("airnow:"), F.col("aqsid"))
    identified = known.withColumns(
        {
            "location_id": location,
            "site_natural_location_id": fn.site_location_id(site_id=F.col("aqsid"), fallback=location),
            "timestamp_end_utc": F.col("timestamp_start_utc") + F.expr("interval 1 hour"),
        }
    )
    return _finish(
        identified,
        source_system=PROVISIONAL,
        dataset=dataset,
        granularity=granularity,
        status="provisional",
        hash_fields=("natural_key", "value_numeric", "unit", "source_last_modified_date", "qualifier_raw"),
    )


def with_region_flag(df: DataFrame, site_id: str, regions: DataFrame, flag: str = "in_region") -> DataFrame:
    """Adds whether a nine-digit site lies in the regions (JOIN-9).

    Its state, or its state and county, must be admitted; a NULL site never is;
    a configuration without any area admits every site.  Two lookup joins, one
    per kind of area, on size-checked tables.
    """
    areas = region_areas(regions)
    states = areas.where(F.col("county_code").isNull()).select(
        F.col("state_code").alias("_area_state"), F.lit(True).alias("_by_state")
    )
    counties = areas.where(F.col("county_code").isNotNull()).select(
        F.concat("state_code", "county_code").alias("_area_county"), F.lit(True).alias("_by_county")
    )
    none_listed = areas.agg(F.count("state_code") == 0).scalar()
    joined = df.join(
        broadcast_if_small(states, regions), F.substring(site_id, 1, 2) == F.col("_area_state"), "left"
    ).join(broadcast_if_small(counties, regions), F.substring(site_id, 1, 5) == F.col("_area_county"), "left")
    member = F.coalesce("_by_state", "_by_county", none_listed)
    return joined.select(*df.columns, (F.col(site_id).isNotNull() & member).alias(flag))


def _finish(
    df: DataFrame,
    *,
    source_system: str,
    dataset: str,
    granularity: str,
    status: str,
    hash_fields: tuple[str, ...],
) -> DataFrame:
    start_iso = fn.iso_text(F.col("timestamp_start_utc"))
    keyed = df.withColumns(
        {
            "metric_type": F.lit(METRIC),
            "data_granularity": F.lit(granularity),
            "source_system": F.lit(source_system),
            "source_dataset": F.lit(dataset),
            "source_priority": F.lit(PRIORITY[source_system]),
            "data_status": F.lit(status),
            "natural_key": fn.natural_key(
                F.col("site_natural_location_id"), F.col("pollutant_code"), F.lit(METRIC), F.lit(granularity), start_iso
            ),
        }
    )
    return keyed.select(
        "object_key",
        fn.row_lineage_hash(F.col("object_key"), F.lit(dataset), F.col("raw_fields")).alias("source_row_hash"),
        "natural_key", "location_id", "site_natural_location_id", "aqsid", "pollutant_code", "metric_type",
        "value_numeric", "unit", "data_granularity", "timestamp_start_utc", "timestamp_end_utc",
        "timestamp_local", "source_system", "source_dataset", "source_priority", "data_status",
        "method_code", "method_name", "qualifier_raw", "source_last_modified_date", "raw_fields",
        fn.record_hash(**{name: F.col(name) for name in hash_fields}).alias("record_hash"),
    )
