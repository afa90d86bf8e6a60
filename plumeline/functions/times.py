"""Date and time expressions (DT-1..DT-14).

All instants are UTC wall time.  Clocks are never read here: callers pass
``as_of``.  Parsing rewrites accepted layouts into ISO text and casts with
``try_cast``; the pattern guards keep out layouts the feeds do not use but a
bare cast would accept (``2026``, ``2026-04``).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumeline.functions.text import non_blank, only, parse_number, strip

_ISO_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_ISO_COMPLETE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})?"
_ISO_PAIR = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}"
_ISO_FULL = (
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(T[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?)?([+-][0-9]{2}(:?[0-9]{2})?)?)?"
)
_SHORT_MINUTE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}"
# Instants that a feed can name: years 1 to 9999.
_FIRST, _LAST = "timestamp'0001-01-01 00:00:00'", "timestamp'9999-12-31 23:59:59.999999'"


def parse_date_time(date_text: Column, time_text: Column) -> Column:
    """Date and ``H:M`` text to a timestamp; blank time is midnight (DT-1)."""
    text = F.concat(strip(date_text), F.lit(" "), F.coalesce(non_blank(time_text), F.lit("00:00")))
    return only(text, _ISO_PAIR).try_cast("timestamp")


def parse_iso_date(value: Column) -> Column:
    """``yyyy-M-d`` or ``yyyyMMdd`` to a date (DT-5, authoritative feed)."""
    text = F.regexp_replace(strip(value), r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return only(text, _ISO_DATE).try_cast("date")


def parse_feed_date(value: Column) -> Column:
    """``yyyy-M-d``, ``yyyy/M/d``, ``M/d/yy`` or ``M/d/yyyy`` to a date (DT-5,
    provisional feed).  Two-digit years 69-99 are 19xx, 00-68 are 20xx."""
    iso = only(strip(value), _ISO_DATE).try_cast("date")
    text = strip(value)
    text = F.regexp_replace(text, r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$", "$1-$2-$3")
    text = F.regexp_replace(text, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", "$3-$1-$2")
    text = F.regexp_replace(text, r"^([0-9]{1,2})/([0-9]{1,2})/(69|[7-9][0-9])$", "19$3-$1-$2")
    text = F.regexp_replace(text, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2})$", "20$3-$1-$2")
    return F.coalesce(iso, only(text, _ISO_DATE).try_cast("date"))  # ISO text skips the rewriting


def parse_utc_timestamp(value: Column) -> Column:
    """ISO text, ``Z`` or offset allowed, naive meaning UTC (DT-6)."""
    complete = only(strip(value), _ISO_COMPLETE).try_cast("timestamp")
    text = F.regexp_replace(strip(value), "Z", "+00:00")
    text = F.regexp_replace(text, r"^([0-9-]+)[T ]", "$1T")
    text = only(text, f"{_ISO_FULL}|{_SHORT_MINUTE}")
    text = F.regexp_replace(text, r"^([^T]+T[0-9]{2})(?=$|[+-])", "$1:00")
    text = F.regexp_replace(text, r"^([^T]+T[0-9]{1,2}:[0-9]{1,2})(?=$|[+-])", "$1:00")
    text = F.regexp_replace(text, r"(T.*[+-][0-9]{2})$", "$1:00")
    text = F.regexp_replace(text, r"(T.*[+-][0-9]{2})([0-9]{2})$", "$1:$2")
    # complete text, the usual case, skips the rewriting
    return F.coalesce(complete, F.translate(text, ",", ".").try_cast("timestamp"))


def parse_hour(value: Column) -> Column:
    """Hour of day from ``HH``, ``HH:MM`` or a decimal; NULL outside 0-23 (DT-4)."""
    hour = parse_number(F.split_part(strip(value), F.lit(":"), F.lit(1))).try_cast("int")
    return F.get(F.array(*map(F.lit, range(24))), hour)


def parse_offset_hours(value: Column) -> Column:
    return parse_number(value)


def local_timestamp(date_text: Column, time_text: Column) -> Column:
    """Local wall time of the provisional feed, tagged as UTC (DT-3)."""
    hour = parse_hour(time_text)
    return parse_feed_date(date_text).cast("timestamp") + F.make_dt_interval(hours=hour)


def local_to_utc(local: Column, offset_hours: Column) -> Column:
    """``local - offset`` with fractional hours; no offset means UTC, and an offset that leads
    out of the years 1 to 9999 has no instant: NULL (DT-3)."""
    micros = F.unix_micros(local) - ((offset_hours * 3600).try_cast("decimal(18,6)") * 1_000_000).cast("bigint")
    shifted = F.when(micros.between(F.unix_micros(F.expr(_FIRST)), F.unix_micros(F.expr(_LAST))), F.timestamp_micros(micros))
    return F.when(offset_hours.isNull(), local).otherwise(shifted)


def iso_text(ts: Column) -> Column:
    """``2026-04-17T13:00:00+00:00``; six fraction digits only when non-zero."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+00:00"))


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def month_of(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def obs_month(ts: Column) -> Column:
    """Partition value of the fact tables: ``yyyy-MM``."""
    return F.date_format(ts, "yyyy-MM")


def windows_between(start: Column, end: Column, unit: str) -> Column:
    """Array of structs (start, end) covering ``[start, end]`` clipped to
    calendar months or years (DT-9, DT-10); empty when ``start > end``."""
    step, trunc = {
        "month": (F.expr("interval 1 month"), "MM"),
        "year": (F.expr("interval 1 year"), "YYYY"),
    }[unit]
    firsts = F.when(start <= end, F.sequence(F.trunc(start, trunc), end, step)).otherwise(
        F.array().cast("array<date>")
    )
    months = 1 if unit == "month" else 12
    return F.transform(
        firsts,
        lambda first: F.struct(
            F.greatest(first, start).alias("start_date"),
            F.least(F.date_sub(F.add_months(first, months), 1), end).alias("end_date"),
        ),
    )


def hour_chunks(start: Column, end: Column, hours: Column | int) -> Column:
    """Array of structs (start, end) of ``hours`` inclusive hours each (DT-13)."""
    size = F.greatest(F.lit(hours) if isinstance(hours, int) else hours, F.lit(1))
    step = F.make_dt_interval(hours=size)
    starts = F.when(start <= end, F.sequence(start, end, step)).otherwise(
        F.filter(F.array(start), lambda _: F.lit(False))
    )
    return F.transform(
        starts,
        lambda first: F.struct(
            first.alias("chunk_start_utc"),
            F.least(first + F.make_dt_interval(hours=size - 1), end).alias("chunk_end_utc"),
        ),
    )


def recent_hours(as_of: Column, hours: int = 48) -> Column:
    """The last ``hours`` complete hours before ``as_of`` (DT-12)."""
    end = F.date_trunc("hour", as_of) - F.expr("interval 1 hour")
    return F.sequence(end - F.make_dt_interval(hours=F.lit(hours - 1)), end, F.expr("interval 1 hour"))


def within_hours(ended_at: Column, as_of: Column, hours: int) -> Column:
    """Freshness predicate ``ended_at >= as_of - n hours``, n at least 1 (DT-14)."""
    return ended_at >= as_of - F.make_dt_interval(hours=F.lit(max(1, hours)))


def as_column(value: Column | datetime | date) -> Column:
    """Literal for a clock or bound passed from Python."""
    return value if isinstance(value, Column) else F.lit(value)
