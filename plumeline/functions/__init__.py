"""Column expressions: public surface of the row-level helpers."""

from plumeline.functions.keys import (
    location_part,
    natural_key,
    record_hash,
    row_lineage_hash,
    site_location_id,
    sorted_map,
)
from plumeline.functions.text import (
    all_present,
    first_non_blank,
    first_nonzero,
    non_blank,
    non_empty,
    normalize_site_id,
    null_if_na,
    parse_number,
    pollutant_key,
    strip,
    zero_fill,
    zero_fill_code,
)
from plumeline.functions.times import (
    as_column,
    day_of,
    hour_chunks,
    iso_text,
    local_timestamp,
    local_to_utc,
    month_of,
    obs_month,
    parse_date_time,
    parse_feed_date,
    parse_hour,
    parse_iso_date,
    parse_offset_hours,
    parse_utc_timestamp,
    recent_hours,
    windows_between,
    within_hours,
)

__all__ = [name for name in dir() if not name.startswith("_")]
