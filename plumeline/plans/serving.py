"""Parameterised serving queries (API-1..4) and dashboard aggregates (AGG-11..13).

Each query can run on a stored mart (``mart=``) or derive it from the tables.
Filters on grouping or ranking keys are applied before the shuffle; results
are the same because those filters keep or drop whole groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.operators import marts
from plumeline.operators.ranking import first_per_key, page
from plumeline.schemas import (
    COVERAGE_COLUMNS,
    GRANULARITIES,
    LATEST_COLUMNS,
    MAP_COLUMNS,
    SOURCE_SYSTEMS,
    TIMESERIES_COLUMNS,
)
from plumeline.session import broadcast_if_small


@dataclass(frozen=True)
class Tables:
    """The tables serving queries read (SRC-7)."""

    current: DataFrame
    history: DataFrame
    location: DataFrame
    pollutant: DataFrame
    threshold: DataFrame


def equal_if_given(df: DataFrame, **values: object) -> DataFrame:
    """Optional equality filters (FLT-2): a parameter left out filters nothing."""
    for column, value in values.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def in_range_if_given(df: DataFrame, column: str, low: object = None, high: object = None) -> DataFrame:
    """Optional inclusive bounds (FLT-3)."""
    if low is not None:
        df = df.where(F.col(column) >= _bound(df, column, low))
    if high is not None:
        df = df.where(F.col(column) <= _bound(df, column, high))
    return df


def _bound(df: DataFrame, column: str, value: object) -> Column:
    # Typed like the column, so that the comparison needs no cast on the column
    # and can be pushed into the scan.
    return F.lit(value).cast(df.schema[column].dataType)


def member_if_given(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Optional set membership (FLT-4)."""
    return df if values is None else df.where(F.col(column).isin(list(values)))


def _allowed(values: Sequence[str] | None, allowed: Sequence[str], name: str) -> Sequence[str] | None:
    if not values:
        return None
    unknown = [v for v in values if v not in allowed]
    if unknown:
        raise ValueError(f"Invalid {name}: {', '.join(unknown)}")
    return list(dict.fromkeys(values))


def _check_window(start: datetime | None, end: datetime | None) -> None:
    if start is not None and end is not None and start > end:
        raise ValueError("start_day_utc must not be after end_day_utc")


def _only_locations(fact: DataFrame, location: DataFrame) -> DataFrame:
    return fact.join(broadcast_if_small(location.select("location_id")), "location_id", "left_semi")


def latest(
    tables: Tables,
    *,
    pollutant_code: str | None = None,
    state_code: str | None = None,
    county_code: str | None = None,
    updated_after_utc: datetime | None = None,
    limit: int = 100,
    offset: int = 0,
    mart: DataFrame | None = None,
) -> DataFrame:
    """Latest daily observation per station and pollutant, newest first (API-1)."""
    if mart is None:
        location = equal_if_given(tables.location, state_code=state_code, county_code=county_code)
        # Rows older than the bound cannot be the latest of a group that passes
        # it, so the bound may go below the ranking and reach the scan.
        fact = in_range_if_given(
            equal_if_given(tables.current, pollutant_code=pollutant_code), "timestamp_start_utc", updated_after_utc
        )
        if state_code is not None or county_code is not None:
            fact = _only_locations(fact, location)
        mart = marts.latest_station(fact, location, tables.pollutant, tables.threshold)
    else:
        mart = equal_if_given(
            mart, pollutant_code=pollutant_code, state_code=state_code, county_code=county_code
        )
        mart = in_range_if_given(mart, "timestamp_start_utc", updated_after_utc)
    order = [
        F.col("timestamp_start_utc").desc_nulls_first(),
        F.col("pollutant_code").asc_nulls_last(),
        F.col("location_id").asc_nulls_last(),
        F.col("threshold_type").asc_nulls_last(),
    ]
    return page(mart.select(*LATEST_COLUMNS), order, limit, offset, 1000)


def map_points(
    tables: Tables,
    *,
    pollutant_code: str | None = None,
    state_code: str | None = None,
    source_systems: Sequence[str] | None = None,
    data_granularities: Sequence[str] | None = None,
) -> DataFrame:
    """Latest history row per station, pollutant, source and granularity, on
    stations with coordinates (API-2, WIN-2, FLT-6), all of them.

    Ranking keeps one row per group, also where several active thresholds
    match it; the first threshold type then decides ``is_exceedance``.
    """
    location = equal_if_given(
        tables.location.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()),
        state_code=state_code,
    )
    fact = equal_if_given(tables.history, pollutant_code=pollutant_code)
    fact = member_if_given(fact, "source_system", _allowed(source_systems, SOURCE_SYSTEMS, "source_systems"))
    fact = member_if_given(
        fact, "data_granularity", _allowed(data_granularities, GRANULARITIES, "data_granularities")
    )
    if state_code is not None:
        fact = _only_locations(fact, location)
    newest_first = [F.col("timestamp_start_utc").desc_nulls_first(), F.col("ingested_at").desc_nulls_first()]
    if "batch_id" in fact.columns:
        newest_first.append(F.col("batch_id").desc_nulls_first())
    ranked = first_per_key(
        fact,
        ["location_id", "pollutant_code", "source_system", "data_granularity"],
        [*newest_first, F.col("record_hash").desc_nulls_first()],
    )
    limits = first_per_key(
        marts.active_thresholds(tables.threshold), ["pollutant_code", "unit"], [F.col("threshold_type").asc_nulls_last()]
    )
    attributes = ("state_code", "county_code", "site_name", "city_name", "latitude", "longitude")
    joined = marts.with_pollutant(marts.with_location(ranked, location, attributes), tables.pollutant)
    joined = joined.join(broadcast_if_small(limits, tables.threshold), ["pollutant_code", "unit"], "left")
    joined = joined.withColumn("is_exceedance", F.col("value_numeric") > F.col("threshold_value"))
    return joined.select(*MAP_COLUMNS)


def map_latest(tables: Tables, *, limit: int = 1000, offset: int = 0, **filters) -> DataFrame:
    """One page of :func:`map_points`, newest first (API-2)."""
    order = [
        F.col("timestamp_start_utc").desc_nulls_first(),
        *[
            F.col(c).asc_nulls_last()
            for c in ("pollutant_code", "location_id", "source_system", "data_granularity")
        ],
    ]
    return page(map_points(tables, **filters), order, limit, offset, 5000)


def timeseries(
    tables: Tables,
    location_id: str,
    pollutant_code: str,
    *,
    start_day_utc: datetime | None = None,
    end_day_utc: datetime | None = None,
    limit: int = 365,
    offset: int = 0,
    mart: DataFrame | None = None,
) -> DataFrame:
    """Daily trend of one station and pollutant, oldest first (API-3)."""
    _check_window(start_day_utc, end_day_utc)
    if mart is None:
        fact = equal_if_given(tables.current, location_id=location_id, pollutant_code=pollutant_code)
        # Whole days pass or fail the bounds, so they translate to bounds on the
        # raw timestamp, which the Parquet scan can use.
        if start_day_utc is not None:
            fact = in_range_if_given(fact, "timestamp_start_utc", _day_at_or_after(start_day_utc))
        if end_day_utc is not None:
            next_day = _bound(fact, "timestamp_start_utc", _midnight(end_day_utc) + timedelta(days=1))
            fact = fact.where(F.col("timestamp_start_utc") < next_day)
        mart = marts.daily_trend(
            fact, equal_if_given(tables.location, location_id=location_id), tables.pollutant
        )
    else:
        mart = equal_if_given(mart, location_id=location_id, pollutant_code=pollutant_code)
        mart = in_range_if_given(mart, "day_utc", start_day_utc, end_day_utc)
    return page(mart.select(*TIMESERIES_COLUMNS), [F.col("day_utc").asc_nulls_last()], limit, offset, 2000)


def coverage(
    tables: Tables,
    *,
    pollutant_code: str | None = None,
    state_code: str | None = None,
    county_code: str | None = None,
    start_day_utc: datetime | None = None,
    end_day_utc: datetime | None = None,
    min_coverage_ratio: float | None = None,
    limit: int = 365,
    offset: int = 0,
    mart: DataFrame | None = None,
) -> DataFrame:
    """Regional coverage by day, newest first (API-4).

    Station totals span all days, so day bounds stay above the aggregation.
    """
    _check_window(start_day_utc, end_day_utc)
    if mart is None:
        fact = equal_if_given(tables.current, pollutant_code=pollutant_code)
        location = equal_if_given(tables.location, state_code=state_code, county_code=county_code)
        mart = marts.region_coverage(fact, location, tables.pollutant)
    else:
        mart = equal_if_given(
            mart, pollutant_code=pollutant_code, state_code=state_code, county_code=county_code
        )
    mart = in_range_if_given(mart, "day_utc", start_day_utc, end_day_utc)
    mart = in_range_if_given(mart, "station_coverage_ratio", min_coverage_ratio)
    order = [
        F.col("day_utc").desc_nulls_first(),
        *[F.col(c).asc_nulls_last() for c in ("pollutant_code", "state_code", "county_code")],
    ]
    return page(mart.select(*COVERAGE_COLUMNS), order, limit, offset, 2000)


def _midnight(value: datetime) -> datetime:
    return value.replace(hour=0, minute=0, second=0, microsecond=0)


def _day_at_or_after(value: datetime) -> datetime:
    day = _midnight(value)
    return day if day == value else day + timedelta(days=1)


def regional_trend(coverage_rows: DataFrame) -> DataFrame:
    """Observations and mean coverage by day over coverage rows (AGG-11)."""
    return coverage_rows.groupBy("day_utc").agg(
        F.sum("observation_count").alias("observation_count"),
        F.avg("station_coverage_ratio").alias("avg_station_coverage_ratio"),
    )


def completeness_kpis(coverage_rows: DataFrame, low_ratio: float = 0.7) -> DataFrame:
    """Mean coverage of the latest day and rows below ``low_ratio`` (AGG-12).

    Grouped by day first, so the latest day is picked from one small row per
    day by a single second aggregate.
    """
    by_day = coverage_rows.groupBy("day_utc").agg(
        F.avg("station_coverage_ratio").alias("ratio"),
        F.count_if(F.col("station_coverage_ratio") < low_ratio).alias("low_rows"),
    )
    return by_day.agg(
        F.max_by("ratio", "day_utc").alias("latest_day_avg_coverage"),
        F.sum("low_rows").alias("rows_below_ratio"),
    )


def map_kpis(map_rows: DataFrame) -> DataFrame:
    """Exceedance count and the sources shown (AGG-13), over all :func:`map_points`."""
    return map_rows.agg(
        F.count_if(F.coalesce("is_exceedance", F.lit(False))).alias("exceedance_points"),
        F.array_join(F.sort_array(F.collect_set("source_system")), ", ").alias("sources_shown"),
    )


def envelope(items: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A page as one row ``items, limit, offset, count`` (API-5).  ``items`` is a result of the queries
    above, which are capped; ``count`` is the number of its rows."""
    packed = items.agg(F.collect_list(F.struct(*items.columns)).alias("items"))
    return packed.select("items", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"), F.size("items").alias("count"))
