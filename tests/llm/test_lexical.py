"""Lexical search against a plain computation of every score."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_list(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return TERM.findall(lowered)


def brute_force(docs, items, k):
    held = [(i, Counter(term_list(t))) for i, t in docs]
    n_all = sum(1 for _, c in held if c)
    l_all = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, counts in held:
            if not counts:
                continue
            m = 75 + 25 * sum(counts.values()) * n_all // l_all
            score = 0
            for t in term_list(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc_id, -score))
    return Counter(out)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def answer(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in df.collect())


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "ünï", "naïve", "A1"]
    return [(i, " ".join(rng.choices(words, weights=[1 / (1 + j) for j in range(len(words))], k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_against_brute_force(spark, k):
    docs = corpus(1, 400) + [(7, "W1 w1"), (7, "W1 w1"), (None, "w1 w2 w3"), (None, None), (1000, ""), (1001, "!!! --"), (1002, "w5 " * 3000)]
    docs += [(2000 + i, "w1 w2 w3 w4") for i in range(300)]
    items = [(0, "w1 w2, W2 w55."), (1, None), (2, "nothing here"), (3, "É ünï; a1"), (3, "É ünï; a1"), (None, "w9 w10 w11 w12")]
    items += [(10 + i, t) for i, (_, t) in enumerate(corpus(2, 30))]
    assert answer(lexical.search(*frames(spark, docs, items), k=k)) == brute_force(docs, items, k)


def test_blocks_and_segments_change_nothing(spark, monkeypatch):
    docs, items = corpus(3, 300), [(i, t) for i, (_, t) in enumerate(corpus(4, 25))]
    expected = brute_force(docs, items, 5)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 900)
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", 100)
    assert answer(lexical.search(*frames(spark, docs, items), k=5)) == expected


def test_strata_below_the_floor_are_not_visited(monkeypatch):
    """Long documents cannot beat short ones that hold the term more often."""
    visits = []
    scores = lexical.Stratum.scores
    monkeypatch.setattr(lexical.Stratum, "scores", lambda self, *a: visits.append(self.docs[0]) or scores(self, *a))
    m = np.repeat(np.arange(80, 1080, 10), 5)
    one = np.ones(len(m), dtype=np.int64)
    segment = lexical.strata(m, one, one * 0, one, np.array([700]))
    vocabulary = {b"w": 0}
    queries = lexical.Queries.of([(1, b"w")], vocabulary)
    best = lexical.Best(1, 5)
    lexical.search_segment(segment, np.arange(len(m)), one < 0, queries, best, 1)
    assert best.kept[0][2].tolist() == [0, 1, 2, 3, 4]
    assert len(visits) == 1


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert lexical.search(docs.where("false"), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0
    assert answer(lexical.search(docs.where("false").unionByName(docs), items)) == brute_force([(1, "a b")], [(1, "a")], 20)


def test_clashing_columns(spark):
    docs, items = frames(spark, corpus(5, 50), [(1, "w1 w2")])
    names = "n m terms tfs row item item_id score rank block before bytes one".split()
    wide = docs.withColumns({c: F.lit("x") for c in names})
    more = items.withColumns({c: F.lit("x") for c in names if c != "item_id"})
    assert answer(lexical.search(wide, more)) == answer(lexical.search(docs, items))
