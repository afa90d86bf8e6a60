"""Quality rules with thresholds learned from mergeable quantile sketches.

Built-in functions only.  Every document gets four shape metrics (integers, per
10,000).  A sketch is a table of bucket counts: integer values are rounded down to
``SKETCH_BITS`` significant bits, so counts of two sketches add up to the sketch of
the union, in any order and with the same result, and a quantile is off by less
than ``2 ** (1 - SKETCH_BITS)`` of its value.  Sketches hold the documents that pass the base rules, are kept per language
and source and merged to language level and to the whole corpus; a group with fewer than ``min_group`` documents uses the
next wider one.  The upper fence of a metric is ``q75 + fence * spread`` and the error of the sketch, the lower ``q25 - ...``,
the spread being ``q75 - q25`` of the group or of its language, whichever is wider (a source made of copies has none of its own).
Thresholds go back to the documents by a join on language and source.

No margin is added to a fence.  Where most documents of a source have none of a thing, the fence is 0; a share
above it counts only if it still is above it with ``EVENTS`` events taken away, as a share of a short text jumps by
one event of it.  So what is normal in a source (symbols in code) is its own sketch's matter, and a few events are never junk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch, words

SKETCH_BITS = 7
# Metric: (counted, per, counted by one event, whether low values count too).  A window found again covers two times three words,
# a word unlike the others (an address, a number) is ten characters longer or shorter.
METRICS = {
    "symbols_per_word": ("n_symbols", "n_words", 1, False),
    "dup_line_share": ("n_dup_lines", "n_lines", 1, False),
    "repeat_share": ("n_repeat_words", "n_words", 6, False),
    "word_length": ("word_chars", "n_words", 10, True),
}
#: Events of a metric that a single document may show beyond its fence.
EVENTS = 5
FENCE = 3
MIN_GROUP = 200


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with word and repetition counts of the whole text.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long).
    Null and empty texts count 0 everywhere.  A word belongs to a repeated window
    when one of the up to three 3-word windows over it occurs again in the text.
    Windows are compared by hash first and, where hashes meet, by their words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn("_words", words(F.col(text)))
    counted = counted.withColumn(
        "_hashes",
        F.when(
            F.size("_words") >= 4,
            F.expr(
                "transform(slice(_words, 1, size(_words) - 2), "
                "(w, i) -> named_struct('h', xxhash64(w, _words[i + 1], _words[i + 2]), 'i', i))"
            ),
        ).otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)")),
    ).withColumn("_hashes", F.sort_array("_hashes"))
    counted = counted.withColumn("_twins", F.expr(_neighbours("_hashes", "x.h = _hashes[k - 1].h", "x.h = _hashes[k + 1].h")))
    counted = counted.withColumn(
        "_windows",
        F.expr(
            "sort_array(transform(_twins, x -> named_struct('a', _words[x.i], 'b', _words[x.i + 1], 'c', _words[x.i + 2], 'i', x.i)))"
        ),
    )
    same = "x.a = _windows[k {0} 1].a and x.b = _windows[k {0} 1].b and x.c = _windows[k {0} 1].c"
    counted = counted.withColumn(
        "_at",
        F.expr(f"sort_array(transform({_neighbours('_windows', same.format('-'), same.format('+'))}, x -> x.i))"),
    )
    covered = F.expr("aggregate(transform(_at, (p, k) -> if(k + 1 < size(_at), least(3, _at[k + 1] - p), 3)), 0, (s, x) -> s + x)")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = counted.withColumn("_lines", lines)
    return counted.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def _neighbours(array: str, before: str, after: str) -> str:
    """Elements of a sorted array that equal the one before or after."""
    return f"filter({array}, (x, k) -> (k > 0 and {before}) or (k + 1 < size({array}) and {after}))"


def _metric_columns() -> list[Column]:
    per = lambda top, bottom: F.expr(f"if({bottom} = 0, 0, 10000 * {top} div {bottom})")
    values = [per(top, bottom).alias(m) for m, (top, bottom, _, _) in METRICS.items()]
    return values + [per(event * EVENTS, bottom).alias(f"{m}_events") for m, (_, bottom, event, _) in METRICS.items()]


def bucket(value: Column) -> Column:
    """The value without all but its first ``SKETCH_BITS`` binary digits."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(metrics: DataFrame) -> DataFrame:
    """Counts per ``(lang, source, metric, bucket)``.  The only shuffle carries one
    row per task and bucket, however many documents a source has."""
    stacked = ", ".join(f"'{m}', {m}" for m in METRICS)
    long = metrics.select("lang", "source", F.expr(f"stack({len(METRICS)}, {stacked}) as (metric, value)"))
    return long.groupBy("lang", "source", "metric", bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP, fence: int = FENCE) -> DataFrame:
    """Lower and upper fence per language, source and metric, one row per language and source."""
    levels = {"own": ["lang", "source"], "language": ["lang"], "corpus": []}
    fences = None
    for level, keys in levels.items():
        merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        running = W.partitionBy(*keys, "metric").orderBy("bucket")
        merged = merged.withColumn("upto", F.sum("n").over(running)).withColumn("total", F.sum("n").over(W.partitionBy(*keys, "metric")))
        quartiles = merged.groupBy(*keys, "metric").agg(
            F.max("total").alias("total"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q25"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q75"),
        )
        quartiles = quartiles.select(*keys, "metric", F.struct("total", "q25", "q75").alias(level))
        if fences is None:
            fences = quartiles
            continue
        match = F.col("w.metric") == F.col("f.metric")
        for key in keys:
            match &= F.col(f"w.{key}").eqNullSafe(F.col(f"f.{key}"))
        fences = fences.alias("f").join(quartiles.alias("w"), match).select("f.*", f"w.{level}")
    chosen = F.when(F.col("own.total") >= min_group, F.col("own")).when(F.col("language.total") >= min_group, F.col("language"))
    fences = fences.withColumn("q", chosen.otherwise(F.col("corpus")))
    width = F.when(F.col("language.total") >= min_group, F.expr("language.q75 - language.q25"))
    spread = F.greatest(F.expr("q.q75 - q.q25"), width) * fence
    low = F.col("metric").isin([m for m, rule in METRICS.items() if rule[-1]])
    error = 1 << (SKETCH_BITS - 1)
    fences = fences.withColumns(
        {
            "upper": F.col("q.q75") + spread + F.expr(f"q.q75 div {error}"),
            "lower": F.when(low, F.col("q.q25") - spread - F.expr(f"q.q25 div {error}")),
        }
    )
    per_metric = [
        F.max(F.when(F.col("metric") == m, F.struct("lower", "upper"))).alias(f"{m}_fence") for m in METRICS
    ]
    return fences.groupBy("lang", "source").agg(*per_metric)


def judge(docs: DataFrame, min_group: int = MIN_GROUP, fence: int = FENCE) -> DataFrame:
    """Base counts and verdict of every document.

    ``docs`` needs ``doc_id, text, lang, source``; other columns are ignored, a null
    language or source is a group of its own.  Returns ``doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules``.
    ``base_failed``: fewer than 50 words (so null and empty texts), or repeated windows
    over more than half of the words.  ``kept``: not base_failed and every metric within its
    fences, its events taken away.  ``failed_rules`` names the others, also of documents that fail the base rules
    (none in a source where all do).  Repeated rows are judged each; an empty table gives no rows.  The text is
    read once; only counts are shuffled, and thresholds come back by a join that
    AQE plans by their measured size and splits on hot sources.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    counts = base_columns(docs.select("doc_id", "lang", "source", "text"))
    scored = scratch.save(
        counts.select(
            "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *_metric_columns()
        )
    )
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fences = thresholds(scratch.save(sketches(scored.where(~base_failed))), min_group, fence)
    failed = [
        F.when(
            (F.col(m) - F.col(f"{m}_events") > F.col(f"{m}_fence.upper")) | (F.col(m) + F.col(f"{m}_events") < F.col(f"{m}_fence.lower")),
            F.lit(m),
        )
        for m in METRICS
    ]
    match = F.col("d.lang").eqNullSafe(F.col("t.lang")) & F.col("d.source").eqNullSafe(F.col("t.source"))
    judged = scored.alias("d").join(fences.alias("t"), match, "left").select(
        "d.*", base_failed.alias("base_failed"), F.concat_ws(" ", *failed).alias("failed_rules")
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
    )


def keep_good(docs: DataFrame, min_group: int = MIN_GROUP, fence: int = FENCE) -> DataFrame:
    """The documents, all columns, that the rules keep.  A document is named by
    ``doc_id`` and the hash of its text, language and source, so rows that share an id
    are judged apart and repeated rows stay together."""
    identity = F.struct("doc_id", F.xxhash64("text", "lang", "source").alias("h"))
    named = docs.select(F.struct(*docs.columns).alias("doc"), identity.alias("identity"))
    judged = named.select(F.col("identity").alias("doc_id"), "doc.text", "doc.lang", "doc.source")
    rejected = judge(judged, min_group, fence).where("not kept").select(F.col("doc_id").alias("rejected")).distinct()
    return named.join(rejected, F.col("identity").eqNullSafe(F.col("rejected")), "left_anti").select("doc.*")
