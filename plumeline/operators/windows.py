"""Date ranges split into request windows (DT-9, DT-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.functions import windows_between


def split_ranges(ranges: DataFrame, unit: str) -> DataFrame:
    """One row per calendar month or year of each (start_date, end_date) range,
    clipped to it; bounds also as ``yyyyMMdd`` text."""
    keys = [c for c in ranges.columns if c not in ("start_date", "end_date")]
    exploded = ranges.select(
        *keys, F.explode(windows_between(F.col("start_date"), F.col("end_date"), unit)).alias("w")
    )
    start, end = F.col("w.start_date"), F.col("w.end_date")
    columns = [*keys, F.date_format(start, "yyyy").alias("year")]
    if unit == "month":
        columns.append(F.date_format(start, "MM").alias("month"))
    return exploded.select(
        *columns, F.date_format(start, "yyyyMMdd").alias("bdate"), F.date_format(end, "yyyyMMdd").alias("edate")
    )


def months_between(ranges: DataFrame) -> DataFrame:
    return split_ranges(ranges, "month")


def years_between(ranges: DataFrame) -> DataFrame:
    return split_ranges(ranges, "year")
