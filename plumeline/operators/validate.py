"""Validation of staged observations (VAL-1, VAL-2, AGG-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline import functions as fn
from plumeline.operators.normalise import with_region_flag
from plumeline.schemas import DATA_STATUSES, PROVISIONAL, REQUIRED_FIELDS, SOURCE_SYSTEMS

VALID, REJECTED, REGION_FILTERED = "valid", "rejected", "region_filtered"
_OPTIONAL_TEXT = ("method_code", "method_name", "qualifier_raw", "aqsid")


def validated(staged: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Adds ``status``: valid, rejected or region_filtered, decided in this order:
    required fields, typed values, source and status domains, region of
    provisional sites.

    Text columns are coerced (``value_numeric``, ``source_priority`` and the
    timestamps may arrive as text); optional text is trimmed to NULL.
    """
    types = dict(staged.dtypes)
    coerced = {
        "value_numeric": fn.parse_number(F.col("value_numeric"))
        if types["value_numeric"] == "string"
        else F.col("value_numeric"),
        "source_priority": F.col("source_priority").try_cast("int"),
    }
    for name in ("timestamp_start_utc", "timestamp_end_utc", "timestamp_local"):
        if types.get(name) == "string":
            coerced[name] = fn.parse_utc_timestamp(F.col(name))
    if types.get("source_last_modified_date") == "string":
        coerced["source_last_modified_date"] = fn.parse_iso_date(F.col("source_last_modified_date"))
    for name in _OPTIONAL_TEXT:
        if name in types:
            coerced[name] = fn.non_blank(F.col(name))

    complete = staged.withColumn("_complete", fn.all_present(*[F.col(name) for name in REQUIRED_FIELDS]))
    typed = complete.withColumns(coerced)
    usable = (
        F.col("_complete")
        & F.col("value_numeric").isNotNull()
        & F.col("source_priority").isNotNull()
        & F.col("timestamp_start_utc").isNotNull()
        & F.col("source_system").isin(*SOURCE_SYSTEMS)
        & F.col("data_status").isin(*DATA_STATUSES)
    )
    status = F.when(~F.coalesce(usable, F.lit(False)), REJECTED)
    if regions is not None:
        typed = with_region_flag(typed.withColumn("_site", fn.normalize_site_id(F.col("aqsid"))), "_site", regions)
        outside = (F.col("source_system") == PROVISIONAL) & ~F.col("in_region")
        status = status.when(outside, REGION_FILTERED)
    return typed.withColumn("status", status.otherwise(VALID)).drop("_complete", "_site", "in_region")


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("status") == VALID).drop("status")


def status_counts(checked: DataFrame) -> DataFrame:
    """One row of load counters (AGG-16)."""
    return checked.agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_rows") for s in (VALID, REJECTED, REGION_FILTERED)]
    )
