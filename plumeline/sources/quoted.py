"""Quoted cells over several lines (SRC-2).

Whether a line begins inside a quoted cell depends on all lines before it.  A line
turns each of the two states into one: it keeps the state (no quotes), sets it, or
flips it.  Within a block of a file the state before a line is the one last set,
flipped by the flips since; a block as a whole does the same to the state before
the block.  So blocks are scanned side by side, for both states at once, and only
one row per block passes along the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A quoted piece of text; possessive, so long cells are matched without recursion.
QUOTED = '"(?:[^"]|"")*+"'
#: Characters of the lines of one record; the customary limit of a field in delimited text.
MAX_RECORD = 131_072


def leaves_open(line: Column, delimiter: str) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted cell."""
    bar = "\\|" if delimiter == "|" else delimiter
    pattern = f'^(?:(?:{QUOTED}|(?!"))[^{bar}]*+{bar})*+"(?:[^"]|"")*+$'
    return F.contains(line, F.lit('"')) & line.rlike(pattern)


def _states(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``in0, in1``: whether a row begins inside quotes if its group begins outside or inside.

    ``out0, out1`` tell how the row itself ends from either state.
    """
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    sets, flips = F.col("out0") == F.col("out1"), F.col("out0") & ~F.col("out1")
    counted = df.withColumn("_flips", F.coalesce(F.count_if(flips).over(before), F.lit(0)))
    last = F.last(F.when(sets, F.struct(F.col("out0").alias("state"), F.col("_flips").alias("flips"))), ignorenulls=True).over(before)
    counted = counted.withColumn("_set", last)
    odd = (F.col("_flips") - F.coalesce("_set.flips", F.lit(0))) % 2 == 1
    return counted.withColumns(
        {f"in{s}": F.coalesce("_set.state", F.lit(bool(s))) != odd for s in (0, 1)}
    ).drop("_flips", "_set")


def whole_records(lines: DataFrame) -> DataFrame:
    """Rows of ``object_key, block_start, line_id, line, piped`` with the lines of a record joined by line breaks.

    A record takes the place of its first line.  One that is left open at the end of a file is closed there.  A record over
    several lines with more than ``MAX_RECORD`` characters stops the job and names its object.  Lines are shuffled by block of
    a file, then by record.
    """
    line = F.col("line")
    opened = F.when(F.col("piped"), leaves_open(line, "|")).otherwise(leaves_open(line, ","))
    inner = F.concat(F.lit('"'), line)  # a line that begins inside reads like one that opens with a quote
    still = F.when(F.col("piped"), leaves_open(inner, "|")).otherwise(leaves_open(inner, ","))
    block = ["object_key", "block_start"]
    judged = lines.withColumns({"out0": opened, "out1": still}).repartition(*block)
    judged = _states(judged, block, "line_id")

    def ends(state: int) -> Column:
        return F.max_by(F.when(F.col(f"in{state}"), F.col("out1")).otherwise(F.col("out0")), "line_id")

    def last_start(state: int) -> Column:
        return F.max(F.when(~F.col(f"in{state}"), F.struct("block_start", "line_id")))

    blocks = judged.groupBy(*block).agg(
        ends(0).alias("out0"), ends(1).alias("out1"), last_start(0).alias("start0"), last_start(1).alias("start1")
    )
    blocks = _states(blocks, ["object_key"], "block_start")
    earlier = W.partitionBy("object_key").orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    start = F.when(F.col("in0"), F.col("start1")).otherwise(F.col("start0"))
    blocks = blocks.select(*block, F.col("in0").alias("_inside"), F.last(start, ignorenulls=True).over(earlier).alias("_open"))

    placed = judged.join(blocks, block).withColumn("inside", F.when(F.col("_inside"), F.col("in1")).otherwise(F.col("in0")))
    here = F.last(F.when(~F.col("inside"), F.struct("block_start", "line_id")), ignorenulls=True).over(
        W.partitionBy(*block).orderBy("line_id")
    )
    placed = placed.withColumn("record", F.coalesce(here, F.col("_open")))
    record = ["object_key", "record"]
    chars = F.sum(F.length("line")).over(W.partitionBy(*record))
    refused = F.raise_error(F.concat(F.lit("quoted cell is not closed: "), F.col("object_key"))).cast("string")
    fitting = placed.withColumn("chars", chars).withColumn("line", F.when(F.col("inside") & (F.col("chars") > MAX_RECORD), refused).otherwise(line))
    pieces = F.sort_array(F.collect_list(F.struct("block_start", "line_id", "line")))
    left_open = F.max_by(F.when(F.col("inside"), F.col("out1")).otherwise(F.col("out0")), F.struct("block_start", "line_id"))
    joined = fitting.groupBy(*record).agg(
        F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("text"),
        left_open.alias("left_open"),
        F.bool_and("piped").alias("piped"),
    )
    whole = F.concat("text", F.when(F.col("left_open"), '"').otherwise(""))
    return joined.select("object_key", "record.*", whole.alias("line"), "piped")
