"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in shuffled order, is served at the rate of the source's
target: the words of the source served before it, plus its own, over the target are its virtual
finish time.  Up to ``MAX_COPIES`` passes over a source follow each other.  All copies of all sources are
range-sorted by virtual finish time, and the running number of words ends the mix at the
budget, the only cut: of the copy that lies across it the first words are taken, of later ones none.  At any virtual
time every source has had that part of its target but for a document in service, so the sources end near their targets, which
together are the budget.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import Scratch, running_totals, words

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MAX_COPIES = 2
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """``source, source_size, weight, target`` per source of ``sized (source, size)``.

    Sources in code point order, null last, take ``WEIGHTS`` in turn.  A target ends
    at ``MAX_COPIES`` times the source's size; what is above is shared again by weight.
    """
    sizes = scratch.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)))
    order = [F.col("source").isNull(), F.col("source")]
    pick = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("before") % len(WEIGHTS) + 1).cast("int"))
    ranked = scratch.save(
        running_totals(sizes, order, "one", scratch).select(
            "source", "source_size", pick.alias("weight"), (F.col("source_size") * MAX_COPIES).alias("cap")
        )
    )
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * BUDGET_PERCENT / 100
    rate = 0.0  # words per weight; sources with cap < weight * rate stay at their cap
    while True:
        full = F.col("cap") < F.col("weight") * F.lit(rate)
        capped, open_weight = ranked.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0))
        ).first()
        if not open_weight:
            break
        higher = (budget - capped) / open_weight
        if higher <= rate:
            break
        rate = higher
    share = F.least(F.col("weight") * F.lit(rate), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", "weight", share.alias("target"))


def schedule(docs: DataFrame, scratch: Scratch, row: str = "_row", seed: int = 20_240_229) -> DataFrame:
    """Both copies of every row of ``docs (row, doc_id, source, size, text_hash)`` with the words taken.

    Returns ``row, doc_id, copy, size, source_size, target, words, mix_start``: the copy's words and
    the words of the mix before it.  Order in a source is a seeded hash of the id, then id,
    hash of the text and row number.
    """
    goal = targets(docs, scratch)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    shuffled = docs.withColumn("_hash", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    shuffle = [F.col("_hash"), F.col("doc_id"), F.col("text_hash")]
    order = [F.col("source").isNull(), F.col("source"), *shuffle, F.col(row)]
    lined = scratch.save(running_totals(shuffled, order, "size", scratch))
    firsts = lined.groupBy("source").agg(F.min("before").alias("first"))
    goal = goal.join(firsts, goal["source"].eqNullSafe(firsts["source"])).select(goal["*"], "first")
    served = lined.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        row, "doc_id", "size", "source_size", "target", "_hash", "text_hash", (F.col("before") - F.col("first")).alias("ahead")
    )
    copies = served.withColumn("copy", F.explode(F.array(*[F.lit(k) for k in range(MAX_COPIES)])))
    start = F.col("copy") * F.col("source_size") + F.col("ahead")
    finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))
    copies = scratch.save(copies.withColumn("finish", finish).drop("ahead"))
    mixed = running_totals(copies, [F.col("finish"), *shuffle, F.col("copy"), F.col(row)], "size", scratch)
    budget = (docs.agg(F.sum("size")).first()[0] or 0) * BUDGET_PERCENT // 100
    room = F.greatest(F.lit(budget) - F.col("before"), F.lit(0))
    return mixed.select(
        row, "doc_id", "copy", "size", "source_size", "target",
        F.least("size", room).cast("long").alias("words"), F.col("before").alias("mix_start"),
    )


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "_row", "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("text_hash")
    )


def taken_words(docs: DataFrame) -> DataFrame:
    """Words the mix takes of every document: ``doc_id, size, source_size, target, taken,
    mix_start`` (the words of the mix before its first copy; null where none is taken).

    ``docs`` needs ``doc_id, source, text``; other columns are ignored.  Null, empty and
    blank texts have size 0 and are taken 0 times; a null source is a source of its own,
    the last; repeated rows are taken each.  No rows, or no words at all, give targets of 0.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(_sized(docs.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("_row"))))
    copies = schedule(sized, scratch)
    return copies.groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("size").alias("size"),
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.sum("words").alias("taken"),
        F.min(F.when(F.col("words") > 0, F.col("mix_start"))).alias("mix_start"),
    ).drop("_row")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: a row of ``docs`` (all columns) for every copy taken.  Of the document
    cut at the budget the text ends with its last word taken.  Null, empty and blank texts are not taken; an empty
    table gives no rows; repeated rows are taken each."""
    scratch = Scratch(docs.sparkSession, "mixing")
    kept = scratch.save(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("_row")))
    sized = scratch.save(_sized(kept.select("_row", "doc.doc_id", "doc.source", "doc.text")))
    copies = schedule(sized, scratch).where("words > 0").select(F.col("_row").alias("_taken"), "size", "words")
    joined = kept.join(copies, F.col("_row") == F.col("_taken"))
    cut = _first_words(F.when(F.col("words") < F.col("size"), F.col("doc.text")), F.col("words"))
    joined = joined.withColumn("cut", F.coalesce(cut, F.col("doc.text")))
    return joined.select(*[F.col("cut").alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


@F.pandas_udf(T.StringType())
def _first_words(text: pd.Series, count: pd.Series) -> pd.Series:
    """Texts up to their ``count``-th word; null texts, those of whole copies, stay null."""

    def cut(body: str, n: int) -> str:
        found = islice(WORD.finditer(body), n - 1, None)
        return body[: next(found).end()]

    return pd.Series([None if body is None else cut(body, n) for body, n in zip(text, count)], dtype=object)
