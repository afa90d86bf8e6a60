"""Hourly delimited files (SRC-2).

Files are read line by line, so a large file is split over tasks.  Only the
facts a line needs about its file (delimiter, header, whether a quoted cell is
left open at the end of a line) are gathered per file with a partial aggregate,
one small row each, and joined back.  Files with a quoted cell over several
lines are put together from their lines first (``quoted.whole_records``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions import strip
from plumeline.operators.ranking import evaluated
from plumeline.schemas import HOURLY_COLUMNS
from plumeline.sources.quoted import QUOTED, leaves_open, whole_records

# Any of these in the first row, lower-cased, makes it a header.
HEADER_TOKENS = ("valid date", "valid time", "aqsid", "parameter name", "value", "gmt offset")
# One layout row per file; up to this many files they are broadcast.
MAX_BROADCAST_FILES = 10_000


def with_line_position(text: DataFrame) -> DataFrame:
    """Adds the file and the position within it to rows of a text source.

    Within one block of a file row ids ascend, and blocks are ordered by their
    start, so (block_start, line_id) orders the lines of a file.
    """
    return text.select(
        F.col("_metadata.file_path").alias("object_key"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.make_valid_utf8("value").alias("line"),
    )


def _cells(line: Column, delimiter: str) -> Column:
    """Cells of a delimited record, quotes resolved."""
    bar = "\\|" if delimiter == "|" else delimiter
    pattern = f"((?:{QUOTED})?[^{bar}]*){bar}"
    raw = F.regexp_extract_all(F.concat(line, F.lit(delimiter)), F.lit(pattern), F.lit(1))
    return F.transform(raw, _unquoted)


def _unquoted(cell: Column) -> Column:
    quoted = cell.rlike(f"^{QUOTED}")
    inner = F.regexp_replace(F.regexp_extract(cell, '^"((?:[^"]|"")*+)"', 1), '""', '"')
    rest = F.regexp_extract(cell, f"^{QUOTED}(.*)$", 1)
    return strip(F.when(quoted, F.concat(inner, rest)).otherwise(cell))


def _split(line: Column, piped: Column) -> Column:
    # Lines without quotes, the usual case, are trimmed and split in one go.
    plain = F.split(strip(line), F.when(piped, F.lit(r"\s*\|\s*")).otherwise(F.lit(r"\s*,\s*")))
    quoted = F.when(piped, _cells(line, "|")).otherwise(_cells(line, ","))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def file_layouts(lines: DataFrame, piped: Column | None = None) -> DataFrame:
    """Delimiter and header cells per file: the first line with any text decides
    the delimiter (unless ``piped`` is given), the first row with any filled cell is the header if it names
    known columns.  ``broken`` tells files with a quoted cell that a line leaves open."""

    def first_with_text(ignored: str) -> Column:
        filled = F.col("line").rlike(rf"[^\s{ignored}]")
        return F.min(F.when(filled, F.struct("block_start", "line_id", "line")))

    found = lines.groupBy("object_key").agg(
        first_with_text("")["line"].alias("first_line"),
        first_with_text('|"').alias("first_piped"),
        first_with_text(',"').alias("first_comma"),
        F.max(leaves_open(F.col("line"), "|")).alias("open_piped"),
        F.max(leaves_open(F.col("line"), ",")).alias("open_comma"),
        *([F.bool_and(piped).alias("known")] if piped is not None else []),
    )
    found = found.withColumn("piped", F.contains("first_line", F.lit("|")) if piped is None else F.col("known")).withColumn(
        "first_row", F.when(F.col("piped"), F.col("first_piped")).otherwise(F.col("first_comma"))
    )
    found = found.withColumn("first_cells", _split(F.col("first_row.line"), F.col("piped")))
    joined = F.lower(F.array_join("first_cells", " "))
    has_header = F.lit(False)
    for token in HEADER_TOKENS:
        has_header = has_header | F.contains(joined, F.lit(token))
    headers = F.when(has_header, F.col("first_cells")).otherwise(F.array(*map(F.lit, HOURLY_COLUMNS)))
    repeats = (F.size(F.array_distinct(headers)) < F.size(headers)) | F.exists(
        headers, lambda h: h.startswith("extra_")
    )
    return found.select(
        "object_key",
        "piped",
        headers.alias("headers"),
        repeats.alias("repeats"),
        F.when(F.col("piped"), F.col("open_piped")).otherwise(F.col("open_comma")).alias("broken"),
        F.when(has_header, F.col("first_row.block_start")).alias("header_block"),
        F.when(has_header, F.col("first_row.line_id")).alias("header_line"),
    )


def parse_hourly_lines(lines: DataFrame, broadcast_layouts: bool = False) -> DataFrame:
    """(object_key, raw_fields) per data row: header cell to trimmed value.

    Surplus cells are named ``extra_<index>``; of repeated headers the last
    wins.  ``broadcast_layouts`` is for callers that know the file count.  Line breaks inside a
    quoted cell are kept, as ``\\n``.
    """
    layouts = file_layouts(lines)
    broken = layouts.where("broken").select("object_key", "piped")
    records = whole_records(lines.join(F.broadcast(broken) if broadcast_layouts else broken, "object_key"))
    whole = _fields(lines, layouts.where(~F.col("broken")), broadcast_layouts)
    return whole.unionByName(_fields(records.drop("piped"), file_layouts(records, F.col("piped")), broadcast_layouts))


def _fields(lines: DataFrame, layouts: DataFrame, broadcast_layouts: bool) -> DataFrame:
    """(object_key, raw_fields) per data row of files whose records are one row of ``lines`` each."""
    rows = lines.join(F.broadcast(layouts) if broadcast_layouts else layouts, "object_key")
    is_header = F.col("block_start").eqNullSafe(F.col("header_block")) & F.col("line_id").eqNullSafe(
        F.col("header_line")
    )
    layout = ("headers", "repeats")
    rows = evaluated(
        rows.where(~is_header), "object_key", *layout, _split(F.col("line"), F.col("piped")).alias("cells")
    )
    rows = rows.where(F.array_join("cells", "") != "")
    entries = F.transform(
        "cells",
        lambda cell, i: F.struct(
            F.coalesce(F.get("headers", i), F.concat(F.lit("extra_"), i.cast("string"))).alias("key"),
            cell.alias("value"),
        ),
    )
    # Usually headers are distinct and cover the cells: two arrays make the map.
    count = F.size("cells")
    simple = ~F.col("repeats") & (count <= F.size("headers"))
    paired = F.map_from_arrays(F.slice("headers", 1, F.greatest(count, F.lit(1))), "cells")
    rows = rows.withColumns(
        {"paired": F.when(simple, paired), "entries": F.when(~simple, entries)}
    )
    keys = F.transform("entries", lambda e: e["key"])
    last_of_key = F.filter(
        "entries",
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size("entries")), e["key"]),
    )
    unique = F.when(F.col("repeats"), last_of_key).otherwise(F.col("entries"))
    fields = F.coalesce("paired", F.map_from_entries(unique))
    return evaluated(rows, "object_key", fields.alias("raw_fields"))


def read_hourly_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    text = spark.read.text(paths)
    few_files = len(text.inputFiles()) <= MAX_BROADCAST_FILES
    return parse_hourly_lines(with_line_position(text), broadcast_layouts=few_files)
