"""Key and hash expressions (NRM-8..NRM-11, NRM-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumeline.functions.text import non_blank, normalize_site_id, zero_fill


def site_location_id(
    *,
    site_id: Column | None = None,
    state_code: Column | None = None,
    county_code: Column | None = None,
    site_number: Column | None = None,
    fallback: Column | None = None,
) -> Column:
    """Site-level location id ``aqs_site:SS:CCC:NNNN`` (NRM-8): from the digits
    of ``site_id``, else from the three codes, else ``fallback``."""
    options = []
    if site_id is not None:
        options.append(
            F.regexp_replace(
                normalize_site_id(site_id), r"^([0-9]{2})([0-9]{3})([0-9]{4})$", "aqs_site:$1:$2:$3"
            )
        )
    if state_code is not None and county_code is not None and site_number is not None:
        # concat is NULL as soon as one code is blank, which moves on to the fallback
        options.append(
            F.concat(
                F.lit("aqs_site:"), zero_fill(non_blank(state_code), 2),
                F.lit(":"), zero_fill(non_blank(county_code), 3),
                F.lit(":"), zero_fill(non_blank(site_number), 4),
            )
        )
    if fallback is not None:
        options.append(F.nullif(fallback, F.lit("")))
    return F.coalesce(*options, F.lit("unknown_location"))


def natural_key(location: Column, pollutant: Column, metric: Column, granularity: Column, start_iso: Column) -> Column:
    """``site|pollutant|metric|granularity|iso_start`` (NRM-9)."""
    bar = F.lit("|")
    return F.concat(location, bar, pollutant, bar, metric, bar, granularity, bar, start_iso)


def record_hash(**fields: Column) -> Column:
    """SHA-256 over the fields as JSON in key order, NULLs kept (NRM-10)."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def sorted_map(value: Column) -> Column:
    """The same map with entries in key order, so equal maps print alike."""
    return F.map_from_entries(F.sort_array(F.map_entries(value)))


def row_lineage_hash(object_key: Column, dataset: Column, raw_fields: Column) -> Column:
    """Identity of one source row inside one landed object (NRM-11)."""
    return record_hash(object_key=object_key, dataset=dataset, source_row=sorted_map(raw_fields))


def location_part(location_id: Column, position: int) -> Column:
    """One-based part of a colon-separated location id, NULL past the end."""
    return F.get(F.split(location_id, ":"), F.lit(position - 1))
