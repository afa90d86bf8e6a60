"""Importance resampling against a plain sum of gains."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumeline.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_list(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return words, [zlib.crc32(f.encode()) for f in runs]


def brute_force(docs, target, percent, least, buckets, longest):
    corpus = Counter(f % buckets for _, t in docs for f in feature_list(t, longest)[1])
    wanted = Counter(f % buckets for t in target for f in feature_list(t, longest)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets)))) for b in range(buckets)}
    rows = []
    for doc_id, text in docs:
        words, found = feature_list(text, longest)
        weight = sum(gain[f % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return Counter(map(tuple, rows))


def corpus(n):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(200)] + ["É", "x9", "The"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(n)]
    return docs + [(3, docs[3][1]), (n, None), (None, "the " * 30), (None, None), (n + 1, "word1 " * 70_000), (n + 2, "--- !!")]


def check(spark, docs, target, **kwargs):
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = Counter(tuple(r) for r in importance.resample(made, wanted, **kwargs).collect())
    options = {"percent": 10, "least_words": 20, "buckets": 10_000, "longest": 1} | kwargs
    assert got == brute_force(docs, target, *options.values())


def test_against_brute_force(spark):
    check(spark, corpus(300), ["word1 word2 word3 The É", "word7", None, ""])


def test_other_settings(spark):
    check(spark, corpus(120), ["word1 word2 word3"], percent=50, least_words=1, buckets=97, longest=3)


def test_empty_target_and_tables(spark):
    check(spark, corpus(30), [])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, none).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame(corpus(40), "doc_id long, text string")
    wide = docs.withColumns({c: F.lit("x") for c in "able row score weight rank before bucket n n_words".split()})
    want = spark.createDataFrame([("word1",)], "text string")
    rows = lambda d: Counter(map(tuple, importance.resample(d, want).collect()))
    assert rows(wide) == rows(docs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 100_000), st.integers(-30_000, 30_000)), min_size=1, max_size=300))
def test_planes_give_exact_sums(pairs):
    counts, gains = (np.array(x, dtype=np.int64) for x in zip(*pairs))
    assert importance.weigh(importance.planes(counts), importance.GainPlanes.of(gains)) == int(counts @ gains)
