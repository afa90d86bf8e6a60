"""The seven serving marts (WIN-1, AGG-1..7, WIN-6..8, MART-EXC).

Every mart reads daily observations only (FLT-1): a partition filter on the
stored fact.  Dimensions are keyed, so attributes that depend on the key alone
are attached *after* aggregating by the key wherever grouping allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.functions import day_of, month_of
from plumeline.operators.ranking import first_per_key
from plumeline.schemas import DAILY
from plumeline.session import broadcast_if_small

BASELINE_ROWS = 30
SPIKE_ZSCORE = 2.5
REGION = ("state_code", "county_code")


def daily_only(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("data_granularity") == DAILY)


def with_location(df: DataFrame, location: DataFrame, columns: Sequence[str] = REGION) -> DataFrame:
    """Inner join to the location dimension (JOIN-1)."""
    return df.join(broadcast_if_small(location.select("location_id", *columns)), "location_id")


def with_pollutant(df: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Inner join to the pollutant dimension (JOIN-2)."""
    return df.join(broadcast_if_small(pollutant.select("pollutant_code", "pollutant_name")), "pollutant_code")


def active_thresholds(threshold: DataFrame) -> DataFrame:
    return threshold.where(F.col("is_active")).select(
        "pollutant_code", "unit", "threshold_type", "threshold_value"
    )


def with_threshold(df: DataFrame, threshold: DataFrame) -> DataFrame:
    """Left join to the active thresholds of the same pollutant and unit
    (JOIN-3); several threshold types give several rows."""
    joined = df.join(broadcast_if_small(active_thresholds(threshold)), ["pollutant_code", "unit"], "left")
    return joined.withColumn("is_exceedance", F.col("value_numeric") > F.col("threshold_value"))


def latest_station(current: DataFrame, location: DataFrame, pollutant: DataFrame, threshold: DataFrame) -> DataFrame:
    """Latest daily observation per station and pollutant (WIN-1).

    Ties on both timestamps go to the smallest ``natural_key``.
    """
    return described_latest(latest_rows(daily_only(current)), location, pollutant, threshold)


def latest_rows(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The latest row per station and pollutant (and per ``within``)."""
    order = [
        F.col("timestamp_start_utc").desc_nulls_first(),
        F.col("updated_at").desc_nulls_first(),
        F.col("natural_key").asc_nulls_last(),
    ]
    return first_per_key(rows, [*within, "location_id", "pollutant_code"], order)


def described_latest(latest: DataFrame, location: DataFrame, pollutant: DataFrame, threshold: DataFrame) -> DataFrame:
    """Latest rows with station, pollutant and thresholds (JOIN-1..3)."""
    attributes = (
        "location_type", "country_code", "state_code", "county_code", "site_number", "aqsid",
        "site_name", "city_name", "latitude", "longitude",
    )
    joined = with_threshold(with_pollutant(with_location(latest, location, attributes), pollutant), threshold)
    return joined.select(
        "natural_key", "location_id", *attributes, "pollutant_code", "pollutant_name", "metric_type",
        "value_numeric", "unit", "data_granularity", "timestamp_start_utc", "timestamp_local",
        "source_system", "source_dataset", "data_status", "threshold_type", "threshold_value",
        "is_exceedance",
    )


def _trend(
    current: DataFrame,
    location: DataFrame,
    pollutant: DataFrame,
    periods: dict[str, Column],
    extra: Sequence[Column] = (),
) -> DataFrame:
    # State, county and pollutant name depend on the grouping keys, so the
    # dimensions join the aggregated rows instead of the fact.
    grouped = (
        daily_only(current)
        .groupBy("location_id", "pollutant_code", *[c.alias(n) for n, c in periods.items()])
        .agg(
            F.avg("value_numeric").alias("avg_value"),
            F.min("value_numeric").alias("min_value"),
            F.max("value_numeric").alias("max_value"),
            F.count(F.lit(1)).alias("observation_count"),
            *extra,
        )
    )
    return described_trend(grouped, location, pollutant)


def described_trend(grouped: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Aggregates by station and pollutant with region and pollutant name."""
    measures = [c for c in grouped.columns if c not in ("location_id", "pollutant_code")]
    return with_pollutant(with_location(grouped, location), pollutant).select(
        *REGION, "location_id", "pollutant_code", "pollutant_name", *measures
    )


def daily_trend(current: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Average, extremes and counts by station, pollutant and day (AGG-1, AGG-4)."""
    return _trend(
        current,
        location,
        pollutant,
        {"day_utc": day_of(F.col("timestamp_start_utc"))},
        (
            F.count_if(F.col("data_status") == "final").alias("final_count"),
            F.count_if(F.col("data_status") == "provisional").alias("provisional_count"),
        ),
    )


def monthly_trend(current: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """The trend by calendar month (AGG-2)."""
    return _trend(current, location, pollutant, {"month_utc": month_of(F.col("timestamp_start_utc"))})


def seasonal_trend(current: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """The trend by year and quarter (AGG-3)."""
    ts = F.col("timestamp_start_utc")
    return _trend(current, location, pollutant, {"year_utc": F.year(ts), "quarter_utc": F.quarter(ts)})


def _station_days(current: DataFrame, location: DataFrame) -> DataFrame:
    """One row per region, pollutant, station and day with its row count.

    Regions with a NULL code are left out: the coverage ratio joins on them.
    """
    counted = (
        daily_only(current)
        .groupBy("location_id", "pollutant_code", day_of(F.col("timestamp_start_utc")).alias("day_utc"))
        .agg(F.count("natural_key").alias("row_count"))
    )
    return in_known_regions(counted, location)


def in_known_regions(counted: DataFrame, location: DataFrame) -> DataFrame:
    known = location.where(F.col("state_code").isNotNull() & F.col("county_code").isNotNull())
    return with_location(counted, known)


def _station_totals(station_days: DataFrame) -> DataFrame:
    # Distinct stations by grouping twice: no task sees more than its share of
    # a large region.  Asking for at least one row keeps ``row_count`` in the
    # plan, so both uses of ``station_days`` read one shuffle.
    stations = (
        station_days.groupBy(*REGION, "pollutant_code", "location_id")
        .agg(F.sum("row_count").alias("row_count"))
        .where(F.col("row_count") >= 0)
    )
    return stations.groupBy(*REGION, "pollutant_code").agg(F.count(F.lit(1)).alias("total_station_count"))


def station_totals(current: DataFrame, location: DataFrame) -> DataFrame:
    """Distinct reporting stations per region and pollutant (AGG-5), NULL regions kept."""
    stations = with_location(
        daily_only(current).select("location_id", "pollutant_code").distinct(), location
    )
    return stations.groupBy(*REGION, "pollutant_code").agg(F.count(F.lit(1)).alias("total_station_count"))


def region_coverage(current: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Observations, reporting stations and coverage ratio by region and day (AGG-6, JOIN-10)."""
    return coverage_of(_station_days(current, location), pollutant)


def coverage_of(station_days: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Coverage from one row per region, pollutant, station and day."""
    observed = station_days.groupBy(*REGION, "pollutant_code", "day_utc").agg(
        F.sum("row_count").alias("observation_count"),
        F.count(F.lit(1)).alias("reporting_station_count"),
    )
    joined = observed.join(_station_totals(station_days), [*REGION, "pollutant_code"])
    ratio = F.col("reporting_station_count").cast("double") / F.col("total_station_count").cast("double")
    return with_pollutant(joined, pollutant).select(
        *REGION, "pollutant_code", "pollutant_name", "day_utc", "observation_count",
        "reporting_station_count", "total_station_count",
        F.when(F.col("total_station_count") > 0, ratio).alias("station_coverage_ratio"),
    )


def exceedance_events(
    current: DataFrame, location: DataFrame, pollutant: DataFrame, threshold: DataFrame
) -> DataFrame:
    """Daily observations strictly above an active threshold (MART-EXC, JOIN-4, FLT-8).

    The thresholds come first: they drop most rows before the wider joins.
    """
    return described_exceedances(above_threshold(daily_only(current), threshold), location, pollutant)


def above_threshold(rows: DataFrame, threshold: DataFrame) -> DataFrame:
    """Rows strictly above an active threshold of their pollutant and unit, once per threshold."""
    joined = rows.join(broadcast_if_small(active_thresholds(threshold)), ["pollutant_code", "unit"])
    return joined.where(F.col("value_numeric") > F.col("threshold_value"))


def described_exceedances(above: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    value, limit = F.col("value_numeric"), F.col("threshold_value")
    return with_pollutant(with_location(above, location), pollutant).select(
        "natural_key", "location_id", *REGION, "pollutant_code", "pollutant_name", "value_numeric",
        "unit", "timestamp_start_utc", "timestamp_local", "source_system", "data_status",
        "threshold_type", "threshold_value",
        (value - limit).alias("exceedance_margin"),
        F.when(limit > 0, F.try_divide(value, limit)).alias("exceedance_ratio"),
    )


def region_day_average(current: DataFrame, location: DataFrame) -> DataFrame:
    """Average and row count by region, pollutant and day (AGG-7); NULL regions form a group.

    The fact is reduced to sums per station and day before the location joins.
    """
    station_days = (
        daily_only(current)
        .groupBy("location_id", "pollutant_code", day_of(F.col("timestamp_start_utc")).alias("day_utc"))
        .agg(F.sum("value_numeric").alias("total"), F.count("value_numeric").alias("measured"), F.count(F.lit(1)).alias("n"))
    )
    return region_days_of(station_days, location)


def region_days_of(station_days: DataFrame, location: DataFrame) -> DataFrame:
    """Region days from ``total, measured, n`` per station, pollutant and day."""
    return (
        with_location(station_days, location)
        .groupBy(*REGION, "pollutant_code", "day_utc")
        .agg(
            F.try_divide(F.sum("total"), F.sum("measured")).alias("day_avg_value"),
            F.sum("n").alias("observation_count"),
        )
    )


def with_trailing_baseline(region_days: DataFrame) -> DataFrame:
    """Mean and sample deviation of the previous 30 rows (WIN-6, WIN-7).

    Both share one window.  Its partitions hold one row per day, so their size
    is bounded by the calendar and not by the number of observations.
    """
    frame = (
        Window.partitionBy(*REGION, "pollutant_code").orderBy("day_utc").rowsBetween(-BASELINE_ROWS, -1)
    )
    return region_days.select(
        "*",
        F.avg("day_avg_value").over(frame).alias("baseline_avg_value"),
        F.stddev_samp("day_avg_value").over(frame).alias("baseline_stddev"),
    )


def anomaly_spikes(current: DataFrame, location: DataFrame, pollutant: DataFrame) -> DataFrame:
    """Region days at least 2.5 deviations off their trailing baseline (WIN-8, FLT-9)."""
    return spikes_of(region_day_average(current, location), pollutant)


def spikes_of(region_days: DataFrame, pollutant: DataFrame) -> DataFrame:
    """The region days that are spikes against the days before them."""
    scored = with_trailing_baseline(region_days)
    delta = F.col("day_avg_value") - F.col("baseline_avg_value")
    spikes = (
        scored.where(F.col("baseline_stddev") > 0)
        .withColumn("anomaly_delta", delta)
        .withColumn("anomaly_zscore", F.try_divide(delta, F.col("baseline_stddev")))
        .where(F.abs("anomaly_zscore") >= SPIKE_ZSCORE)
    )
    return with_pollutant(spikes, pollutant).select(
        *REGION, "pollutant_code", "pollutant_name", "day_utc", "day_avg_value", "observation_count",
        "baseline_avg_value", "baseline_stddev", "anomaly_delta", "anomaly_zscore",
    )
