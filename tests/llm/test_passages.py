"""Repeated passages of several lines between different neighbours."""

from __future__ import annotations

import random

from plumeline.llm import line_dedup


def longest_shared(texts: dict) -> dict:
    """By brute force: the lines of every text in a run of enough words, both ends with words, that an earlier place has too."""
    seen, cut = set(), {}
    for doc_id in sorted(texts):
        lines = texts[doc_id].split("\n")
        cut[doc_id] = set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if lines[a].split() and lines[b - 1].split() and len(" ".join(run).split()) >= line_dedup.PASSAGE:
                    if run in seen:
                        cut[doc_id].update(range(a, b))
        seen |= {tuple(lines[a:b]) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1)}
    return cut


def test_passages_between_different_neighbours(spark):
    made = random.Random(5)
    word = lambda: f"w{made.randrange(10**9)}"
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [[line(n) for _ in range(k)] for k, n in [(2, 30), (3, 20), (4, 15), (6, 10), (10, 20), (3, 10), (1, 60)] * 3]
    passages[4].insert(3, "")
    texts = {}
    for i in range(40):
        own = lambda: [line(made.randint(1, 12)) for _ in range(made.randint(1, 4))]
        first, second = made.sample(passages, 2)
        texts[i] = "\n".join([*own(), *first, *own(), *second, *own()])
    cut = longest_shared(texts)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.text, r.lines_out) for r in line_dedup.rewritten(rows).select("doc.doc_id", "text", "lines_out").collect()}
    for i, text in texts.items():
        kept = [x for k, x in enumerate(text.split("\n")) if k not in cut[i]]
        assert found[i] == ("\n".join(kept), len(cut[i]))


def test_lines_that_repeat_apart_stay(spark):
    lines = [" ".join(f"l{i}x{k}" for k in range(20)) for i in range(4)]
    rows = [(i, f"{lines[i]}\nown {i}") for i in range(4)] + [(9, "\n".join(lines))]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == dict(rows)


def test_one_line_over_and_over_keeps_a_passage(spark):
    rows = [(1, "\n".join(["ten words on a line " * 2] * 30))]
    found = line_dedup.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).first().text
    assert len(found.split("\n")) == 5
