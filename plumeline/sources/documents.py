"""JSON feed documents (SRC-1, SRC-3).

Each document is one JSON value, read as ``variant``: numbers and strings stay
apart, which the zero-fallback rule of daily values depends on, and rows may
carry any fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.operators.ranking import evaluated
from plumeline.schemas import AUTHORITATIVE_FIELDS

# Envelope keys that may hold the rows, in order of preference.
ENVELOPE_KEYS = ("Data", "Body", "data", "body")
# Measures where a JSON number zero means "not reported"; text is left alone.
_ZERO_IS_ABSENT = ("arithmetic_mean", "first_max_value")


def read_json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(object_key, doc) per file; unreadable JSON gives a NULL document, which the row
    readers below refuse."""
    reader = spark.read.option("multiLine", True).option("singleVariantColumn", "doc")
    return reader.json(paths).select(F.col("_metadata.file_path").alias("object_key"), "doc")


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _rows(documents: DataFrame, rows: Column) -> DataFrame:
    """Objects among ``rows``.  A document that is no JSON stops the job and names its object:
    skipping it would lose its observations unseen."""
    unreadable = F.raise_error(F.concat(F.lit("unreadable JSON document: "), F.coalesce("object_key", F.lit("?"))))
    rows = F.when(F.col("doc").isNull(), unreadable.cast("array<variant>")).otherwise(rows)
    exploded = documents.select("object_key", F.explode(rows).alias("row"))
    return exploded.where(_is_object(F.col("row")))


def authoritative_rows(documents: DataFrame) -> DataFrame:
    """Rows of authoritative documents (SRC-1): the top-level list, or the first
    envelope key holding a list; elements that are no objects are dropped."""
    doc = F.col("doc")
    options = [F.try_variant_get(doc, "$", "array<variant>")]
    options += [F.try_variant_get(doc, f"$.{key}", "array<variant>") for key in ENVELOPE_KEYS]
    row = F.col("row")

    def text(name: str) -> Column:
        value = F.try_variant_get(row, f"$.{name}", "string")
        if name in _ZERO_IS_ABSENT:
            number = F.schema_of_variant(F.try_variant_get(row, f"$.{name}", "variant")) != "STRING"
            value = F.when(~(number & (value.try_cast("double") == 0)), value)
        return value.alias(name)

    return _rows(documents, F.coalesce(*options)).select(
        "object_key",
        *[text(name) for name in AUTHORITATIVE_FIELDS],
        F.try_variant_get(row, "$", "map<string,string>").alias("raw_fields"),
    )


def gap_fill_rows(documents: DataFrame) -> DataFrame:
    """Rows of gap-fill documents (SRC-3): objects of a top-level list."""
    rows = _rows(documents, F.try_variant_get(F.col("doc"), "$", "array<variant>"))
    return evaluated(
        rows, "object_key", F.try_variant_get(F.col("row"), "$", "map<string,string>").alias("raw_fields")
    )
