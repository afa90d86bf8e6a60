"""The mix against a plain fair queue."""

from __future__ import annotations

import random
from collections import defaultdict

from plumeline.llm import mixing


def corpus(seed, n):
    rng = random.Random(seed)
    return [(i, rng.choice("abcdef") if rng.random() < 0.9 else None, " ".join(["w"] * int(rng.paretovariate(1.2) * 5))) for i in range(n)]


def test_one_cut_at_the_budget_and_sources_near_their_targets(spark):
    docs = corpus(1, 600)
    rows = mixing.taken_words(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    source = {i: s for i, s, _ in docs}
    sums, targets, longest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        sums[s] += r.taken
        targets[s] = r.target
        longest[s] = max(longest[s], r.size)
    total = sum(r.size for r in rows)
    assert sum(sums.values()) == total * 150 // 100
    # whole copies but for one document, which the budget cuts
    assert sum(1 for r in rows if r.size and r.taken % r.size) <= 1
    for s, target in targets.items():
        assert abs(sums[s] - target) <= max(longest.values()), s
    assert all(r.taken <= 2 * r.size for r in rows)
    # the taken copies lie end to end in the mix
    assert min(r.mix_start for r in rows if r.taken) == 0


def test_finish_times_order_the_mix(spark):
    """Sources of one size and weights 3 and 1: of the first copies three of one follow one of the other."""
    docs = [(i, s, "w " * 10) for i, s in enumerate("ab" * 40)]
    rows = mixing.taken_words(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    place = {r.doc_id: r.mix_start for r in rows if r.taken}
    early = [i % 2 for i in sorted(place, key=place.get)[:20]]
    by_target = {i % 2: r.target for i, r in ((r.doc_id, r) for r in rows)}
    share = by_target[0] / sum(by_target.values())
    assert abs(early.count(0) / 20 - share) < 0.1
