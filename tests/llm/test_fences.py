"""Thresholds are learned: the same text is normal in one source and junk in another."""

from __future__ import annotations

import random

from plumeline.llm import quality

SHAPE = "doc_id long, text string, lang string, source string"


def _prose(made, i):
    return " ".join(f"{made.choice('abcdefgh') * made.randint(2, 8)}{i % 10}" for _ in range(made.randint(60, 200)))


def test_code_symbols_are_normal_in_code_only(spark):
    made = random.Random(5)
    code = lambda i: " ".join(w + "|$" * made.randint(0, 2) for w in _prose(made, i).split())
    rows = [(i, _prose(made, i), "en", f"prose{i % 4}") for i in range(1000)] + [(2000 + i, code(i), "en", "code") for i in range(250)]
    same = code(9999)
    rows += [(5000, same, "en", "code"), (5001, same, "en", "prose0")]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SHAPE)).collect()}
    assert judged[5000].kept
    assert not judged[5001].kept and "symbols_per_word" in judged[5001].failed_rules
    assert sum(r.kept for i, r in judged.items() if i < 5000) == 1250


def test_junk_in_a_prose_language(spark):
    made = random.Random(6)
    rows = [(i, _prose(made, i), "en", f"s{i % 2}") for i in range(600)]
    text = _prose(made, 9999)
    few = text.replace(" ", " # ", 4)
    rows += [(5000, text.replace(" ", " ## "), "en", "s0"), (5001, few, "en", "s0")]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SHAPE)).collect()}
    assert judged[5000].failed_rules.startswith("symbols_per_word") and judged[5001].kept


def test_copies_do_not_shut_out_the_rest(spark):
    made = random.Random(7)
    rows = [(i, _prose(made, i), "en", "a") for i in range(300)] + [(400 + i, _prose(made, i), "en", "b") for i in range(200)]
    rows += [(1000 + i, rows[0][1], "en", "b") for i in range(250)]
    judged = quality.judge(spark.createDataFrame(rows, SHAPE))
    assert judged.where("kept").count() == len(rows)
