"""Table schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the observation model.
AUTHORITATIVE = "AQS"
PROVISIONAL = "AIRNOW"
SOURCE_SYSTEMS = ("AQS", "AIRNOW")
DATA_STATUSES = ("final", "provisional")
GRANULARITIES = ("daily", "hourly", "sample")
PRIORITY = {"AQS": 100, "AIRNOW": 10}
METRIC = "concentration"
DAILY = "daily"

# Staged feeds and what each job reads (SRC-5).
FEEDS = ("aqs_sample", "aqs_daily", "airnow_hourly_file", "airnow_gapfill_json")
JOB_FEEDS = {
    "airnow_gap_bootstrap_manual": ("airnow_gapfill_json",),
    "airnow_hourly_hot_sync": ("airnow_hourly_file",),
    "aqs_bootstrap_manual": ("aqs_sample", "aqs_daily"),
    "aqs_daily_reconcile": ("aqs_sample", "aqs_daily"),
}

# Fields a staged observation must carry (VAL-1).
REQUIRED_FIELDS = (
    "natural_key", "location_id", "pollutant_code", "metric_type", "value_numeric", "unit",
    "data_granularity", "timestamp_start_utc", "source_system", "source_dataset",
    "source_priority", "data_status", "record_hash",
)


def _struct(ddl: str) -> T.StructType:
    types = {
        "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(),
        "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
        "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    }
    fields = [column.split() for column in ddl.split(", ")]
    return T.StructType([T.StructField(name, types[kind]) for name, kind in fields])


# Columns of the tables.
_FACT = (
    "natural_key string, location_id string, pollutant_code string, metric_type string, value_numeric "
    "double, unit string, data_granularity string, timestamp_start_utc timestamp, timestamp_end_utc "
    "timestamp, timestamp_local timestamp, source_system string, source_dataset string, source_priority "
    "int, data_status string, method_code string, method_name string, qualifier_raw string, "
    "source_last_modified_date date, record_hash string"
)
FACT_COLUMNS = tuple(column.split()[0] for column in _FACT.split(", "))
HISTORY = _struct(_FACT + ", ingested_at timestamp, batch_id bigint")
CURRENT = _struct(_FACT + ", updated_at timestamp")

# One normalised observation as staged, with its source row kept as a map.
STAGED = _struct(
    "object_key string, source_row_hash string, " + _FACT + ", "
    "site_natural_location_id string, aqsid string, raw_fields map<string,string>, ingested_at timestamp"
)

POLLUTANT = _struct(
    "pollutant_code string, pollutant_name string, default_unit string, metadata string"
)
LOCATION = _struct(
    "location_id string, location_type string, country_code string, state_code string, county_code "
    "string, site_number string, poc string, aqsid string, site_name string, city_name string, "
    "timezone_name string, timezone_offset_hours double, latitude double, longitude double, metadata "
    "string"
)
THRESHOLD = _struct(
    "pollutant_code string, threshold_type string, threshold_value double, unit string, is_active "
    "boolean, metadata string, updated_at timestamp"
)
MANIFEST = _struct(
    "dataset string, object_key string, source_url string, content_sha256 string, extracted_at timestamp, "
    "metadata map<string,string>"
)
# A landed object with its text.
OBJECT = _struct("dataset string, object_key string, body string")
WATERMARK = _struct(
    "source_name string, watermark_key string, watermark_value string, updated_at timestamp"
)
RUN_EVENT = _struct(
    "run_id string, dag_id string, task_id string, run_type string, event_ts timestamp, started_at "
    "timestamp, ended_at timestamp, status string, message string"
)
AUDIT = _struct(
    "natural_key string, old_value double, new_value double, old_hash string, new_hash string, "
    "observed_at timestamp, batch_id bigint"
)
ISSUE = _struct(
    "issue_type string, natural_key string, issue_detail string, created_at timestamp"
)

# Raw feed rows after reading: text fields plus the whole row as a map.
AUTHORITATIVE_FIELDS = (
    "parameter_code", "param", "sample_measurement", "arithmetic_mean", "first_max_value", "aqi",
    "state_code", "county_code", "site_number", "poc", "date_gmt", "time_gmt", "date_local",
    "time_local", "units_of_measure", "unit_of_measure", "date_of_last_change", "method_code",
    "method_name", "qualifier", "qualifiers",
)
# Alias columns of the provisional feed, in order of preference.
PROVISIONAL_ALIASES = {
    "parameter": ("ParameterName", "parameter name", "Parameter", "parameter"),
    "value": ("Value", "value", "RawConcentration", "raw concentration"),
    "site": ("AQSID", "FullAQSCode", "IntlAQSCode", "full AQSID", "aqsid"),
    "utc": ("UTC", "utc"),
    "date": ("ValidDate", "DateObserved", "valid date"),
    "time": ("ValidTime", "HourObserved", "valid time"),
    "offset": ("GMTOffset", "gmt offset", "UTCOffset"),
    "unit": ("ReportingUnits", "reporting units", "Unit", "unit"),
    "changed": ("DateObserved", "ValidDate"),
    "agency": ("DataSource", "data source", "AgencyName", "agency name"),
}
# Columns of an hourly file without a header row.
HOURLY_COLUMNS = (
    "ValidDate", "ValidTime", "AQSID", "SiteName", "GMTOffset", "ParameterName",
    "ReportingUnits", "Value", "DataSource",
)

# Serving result layouts (API-5).
LATEST_COLUMNS = (
    "natural_key", "location_id", "state_code", "county_code", "site_name", "city_name", "latitude",
    "longitude", "pollutant_code", "pollutant_name", "value_numeric", "unit", "timestamp_start_utc",
    "source_system", "data_status", "threshold_type", "threshold_value", "is_exceedance",
)
MAP_COLUMNS = (
    "natural_key", "location_id", "state_code", "county_code", "site_name", "city_name", "latitude",
    "longitude", "pollutant_code", "pollutant_name", "value_numeric", "unit", "timestamp_start_utc",
    "data_granularity", "data_status", "source_system", "source_dataset", "is_exceedance",
)
TIMESERIES_COLUMNS = (
    "location_id", "pollutant_code", "pollutant_name", "day_utc", "avg_value", "min_value",
    "max_value", "observation_count", "final_count", "provisional_count",
)
COVERAGE_COLUMNS = (
    "state_code", "county_code", "pollutant_code", "pollutant_name", "day_utc", "observation_count",
    "reporting_station_count", "total_station_count", "station_coverage_ratio",
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast, reorder, NULL for absent columns."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
