"""Text clean-up expressions for feed fields (NRM-3..7, NRM-12, NRM-14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b"
# Grammar of a decimal number in the feeds: no type suffix (``1.5d``), no
# ``nan``/``inf`` words, both of which a plain cast to double would let through.
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def non_blank(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left (NRM-14)."""
    return F.nullif(strip(value), F.lit(""))


def non_empty(value: Column) -> Column:
    """NULL only for the empty string; blanks stay (the feed's ``or`` chains)."""
    return F.nullif(value, F.lit(""))


def first_non_blank(*values: Column) -> Column:
    """First alias column holding text, trimmed (NRM-3)."""
    return F.coalesce(*[non_blank(v) for v in values])


def null_if_na(value: Column) -> Column:
    """Trimmed text with blanks and the word ``na`` as NULL (NRM-14)."""
    text = non_blank(value)
    return F.when(F.lower(text) != "na", text)


def only(value: Column, pattern: str) -> Column:
    """``value`` where the whole text matches, else the empty text.

    Written as one replacement so that ``value``, often a chain of replacements
    itself, appears once in the plan; a ``when`` would evaluate it twice.
    """
    return F.regexp_replace(value, rf"^(?!(?:{pattern})$)[\s\S]*$", "")


def zero_fill(value: Column, width: int) -> Column:
    """Left-pad with zeros without ever truncating (``lpad`` alone truncates)."""
    return F.lpad(value, F.greatest(F.length(value), F.lit(width)), F.lit("0"))


def zero_fill_code(value: Column, width: int) -> Column:
    """Zero-filled code; blank becomes zero-filled ``na`` (NRM-6)."""
    return zero_fill(F.coalesce(non_blank(value), F.lit("na")), width)


def parse_number(value: Column) -> Column:
    """Text to double, NULL when it is not a finite decimal number (NRM-4)."""
    number = only(strip(value), NUMBER).try_cast("double")
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def first_nonzero(*values: Column) -> Column:
    """``a or b or c`` over typed measures: zero falls through, but the last
    operand is taken as it is (NRM-5)."""
    *leading, last = values
    return F.coalesce(*[F.nullif(v, F.lit(0.0)) for v in leading], last)


def normalize_site_id(value: Column) -> Column:
    """Nine-digit site id: the last nine digits, NULL below nine (NRM-7)."""
    digits = F.regexp_replace(value, r"[^0-9]+", "")
    return F.get(F.regexp_extract_all(digits, F.lit(r"([0-9]{9})$"), F.lit(1)), F.lit(0))


def pollutant_key(value: Column) -> Column:
    """Lookup form of a pollutant name: lower case, ``[a-z0-9.]`` only (NRM-12)."""
    return F.regexp_replace(F.lower(strip(F.coalesce(value, F.lit("")))), r"[^a-z0-9.]+", "")


def all_present(*values: Column) -> Column:
    """True when every value is neither NULL nor the empty string (VAL-1)."""
    return reduce(
        lambda a, b: a & b,
        [F.coalesce(v.cast("string") != "", F.lit(False)) for v in values],
    )
