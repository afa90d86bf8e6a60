"""A training corpus from ``documents``: five stages, each over all its predecessor kept.

quality rules -> line dedup -> near-dedup -> mixing to target weights -> packing
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.llm import line_dedup, minhash, mixing, packing, quality
from plumeline.llm.common import Scratch

TOKENIZER = "word_bpe_49k.json"


def _as_documents(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` brought up to date."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive fences keep."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has."""
    return _as_documents(line_dedup.drop_repeated_chunks(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8)."""
    return minhash.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    return _as_documents(mixing.mix(docs), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of 4096-token sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near-dedup", near_dedup),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Rolling hashes, minhashes and tokens have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
