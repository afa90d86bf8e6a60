"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumeline.llm import (
    ann,
    html_text,
    importance,
    lexical,
    licences,
    line_dedup,
    minhash,
    mixing,
    packing,
    pieces,
    quality,
    sharding,
    url_rules,
)
from plumeline.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and adaptive verdict of every document."""
    return quality.judge(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated passages."""
    return line_dedup.rewritten(_table(spark, sf_dir, "documents")).select("doc.doc_id", "text", "lines_out", "words_out")


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that speaks of a licence."""
    return licences.scan(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=40)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 percent takes of every document."""
    return mixing.taken_words(_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid-out visible text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets agree to 85 percent."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85, halves=10, rows=3)


# The contract's rules (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string").coalesce(1)
    return url_rules.judge(_table(spark, sf_dir, "pages"), rules)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that rank highest for every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and draw of every document towards the benchmark's texts."""
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    ids = pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model_file)
    return pieces.digests(pieces.decode(ids, model_file))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_licence_scan": op3_licence_scan,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_html_text": op7_html_text,
    "op8_neighbours": op8_neighbours,
    "op9_minhash": op9_minhash,
    "op10_url_rules": op10_url_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_importance": op12_importance,
    "op13_sentencepiece": op13_sentencepiece,
}
