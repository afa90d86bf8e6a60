"""Configuration dimensions (SRC-6): pollutants, regions, thresholds.

The defaults are fixed values of the observation domain; callers may pass
their own rows.  They become local relations, whose size the planner knows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.functions import pollutant_key
from plumeline.functions.text import zero_fill

# Pollutant code, name, default unit.
POLLUTANTS = [
    ("44201", "Ozone", "ppm"),
    ("42401", "Sulfur Dioxide", "ppb"),
    ("42101", "Carbon Monoxide", "ppm"),
    ("42602", "Nitrogen Dioxide", "ppb"),
    ("81102", "PM10 Total 0-10um STP", "ug/m3"),
    ("88101", "PM2.5 - Local Conditions", "ug/m3"),
]

# Short names of the provisional feed and their pollutant code.
POLLUTANT_ALIASES = [
    ("pm25", "88101"),
    ("pm2.5", "88101"),
    ("pm10", "81102"),
    ("ozone", "44201"),
    ("o3", "44201"),
    ("sulfurdioxide", "42401"),
    ("so2", "42401"),
    ("nitrogendioxide", "42602"),
    ("no2", "42602"),
    ("carbonmonoxide", "42101"),
    ("co", "42101"),
]

# Region id, country, name, states, (state, county) pairs.
REGIONS = [
    {"id": "us_ca_sf_bay", "country": "US", "name": "San Francisco Bay Area", "state_codes": ["06"]},
    {"id": "us_ny_metro", "country": "US", "name": "New York Metro", "state_codes": ["34"]},
]

# Pollutant code, threshold type, threshold value, unit.
THRESHOLDS = [
    ("44201", "ozone_8h_standard", 0.070, "ppm"),
    ("88101", "pm25_24h_standard", 35.0, "ug/m3"),
    ("81102", "pm10_24h_standard", 150.0, "ug/m3"),
]


_ARROW_TYPES = {
    "string": pa.string(),
    "double": pa.float64(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp": pa.timestamp("us", tz="UTC"),
    "map<string,string>": pa.map_(pa.string(), pa.string()),
}


def local_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """Small literal table as a local relation."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [()] * len(struct.fields)
    table = pa.table(
        {
            field.name: pa.array(list(values), type=_ARROW_TYPES[field.dataType.simpleString()])
            for field, values in zip(struct.fields, columns)
        }
    )
    return spark.createDataFrame(table)


def pollutant_config(spark: SparkSession, rows: Iterable[Sequence] = POLLUTANTS) -> DataFrame:
    """Configured pollutants; rows without a code are skipped."""
    table = local_rows(spark, rows, "pollutant_code string, pollutant_name string, default_unit string")
    return table.where(F.col("pollutant_code") != "")


def pollutant_aliases(
    spark: SparkSession,
    pollutants: Iterable[Sequence] = POLLUTANTS,
    aliases: Iterable[Sequence] = POLLUTANT_ALIASES,
) -> DataFrame:
    """Lookup key to pollutant code (NRM-12); an alias overrides a configured name."""
    named = [(name, code, 0) for code, name, *_ in pollutants if code and name]
    listed = [(alias, code, 1) for alias, code in aliases if code]
    table = local_rows(spark, named + listed, "name string, pollutant_code string, precedence int")
    keyed = table.groupBy(pollutant_key(F.col("name")).alias("alias_key"))
    return keyed.agg(F.max_by("pollutant_code", "precedence").alias("pollutant_code"))


def threshold_config(spark: SparkSession, rows: Iterable[Sequence] = THRESHOLDS) -> DataFrame:
    """Configured thresholds with their ``position``, which decides between repeated keys."""
    return local_rows(
        spark,
        [(*row, i) for i, row in enumerate(rows)],
        "pollutant_code string, threshold_type string, threshold_value double, unit string, position int",
    )


def region_config(
    spark: SparkSession,
    regions: Iterable[Mapping] = REGIONS,
    region_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Regions with their states and county pairs, optionally a selection of ids.

    An unknown selection is an error, as a silent empty list would admit all rows.
    """
    wanted = {r.strip() for r in region_ids or () if r.strip()}
    chosen = [r for r in regions if not wanted or str(r.get("id", "")).strip() in wanted]
    if wanted and not chosen:
        raise ValueError("No regions matched the requested ids.")
    rows = [
        (
            str(r.get("id", "unknown")).strip() or "unknown",
            r.get("name"),
            r.get("country"),
            [str(s).strip() for s in r.get("state_codes", []) if str(s).strip()],
            [
                (str(p["state_code"]).strip(), str(p["county_code"]).strip())
                for p in r.get("state_county_pairs", [])
                if str(p.get("state_code", "")).strip() and str(p.get("county_code", "")).strip()
            ],
        )
        for r in chosen
    ]
    flat = [
        (region_id, name, country, state, None)
        for region_id, name, country, states, _ in rows
        for state in states
    ] + [
        (region_id, name, country, state, county)
        for region_id, name, country, _, pairs in rows
        for state, county in pairs
    ]
    table = local_rows(
        spark, flat, "region_id string, region_name string, country string, state_code string, county_code string"
    )
    return table.select(
        "region_id", "region_name", "country",
        zero_fill(F.col("state_code"), 2).alias("state_code"),
        zero_fill(F.col("county_code"), 3).alias("county_code"),
    )


def region_areas(regions: DataFrame) -> DataFrame:
    """Distinct admitted areas over all regions (SET-3); NULL county means the whole state."""
    return regions.select("state_code", "county_code").distinct()
