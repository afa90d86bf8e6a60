"""First row per key, ordered pages, and a projection evaluated once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Row ranked first within each key (WIN-1..5, MRG-2, MRG-4).

    ``row_number() = 1`` lets Spark keep one row per key in every map task
    before the shuffle (``WindowGroupLimit``), so a key holding a large share
    of the rows sends at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0, max_limit: int | None = None) -> DataFrame:
    """``ORDER BY … LIMIT n OFFSET m`` (TOP-1); a top-k per task, not a full sort."""
    if limit < 1 or (max_limit is not None and limit > max_limit):
        raise ValueError(f"limit must be between 1 and {max_limit}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def evaluated(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Projection whose results later filters use as values.

    The optimizer pushes a filter below a plain projection by repeating the
    projected expressions in it; for parsed feed fields that means parsing each
    row several times.  Generated columns stop it.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
