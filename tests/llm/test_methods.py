"""Operators against oracles, brute force, round trips and held-out accuracy."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plumeline.llm import ann, html_text, licences, line_dedup, minhash, packing, quality, queries, sharding, url_rules
from plumeline.llm.common import Scratch, components, running_totals
from tests.oracle import connect, mismatch

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    assert mismatch(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


def test_quality_plan_is_native(spark):
    scored = quality.base_columns(spark.read.parquet(f"{SF}/documents.parquet"))
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_junk_is_rejected_and_prose_kept(spark):
    made = random.Random(1)
    prose = lambda i: " ".join(f"w{i}x{k}" for k in range(made.randint(60, 200)))
    rows = [(i, prose(i), "en", "s") for i in range(400)] + [(1000 + i, prose(i).replace(" ", "### "), "en", "s") for i in range(20)]
    kept = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).where("kept")
    assert {r.doc_id for r in kept.collect()} == set(range(400))


def test_bucket_error_is_bounded(spark):
    values = spark.range(0, 50_000, 7).withColumn("b", quality.bucket(F.col("id")))
    assert values.where("b > id or id - b > id / 64").count() == 0


def expected_cuts(texts: dict) -> dict:
    seen, removed = set(), defaultdict(set)
    for doc_id in sorted(texts):
        for k, body in line_dedup._candidates((texts[doc_id] or "").encode()):
            if body in seen:
                removed[doc_id].add(k)
            seen.add(body)
    return {i: line_dedup.cut_chunks(t, removed[i])[0] if t is not None else None for i, t in texts.items()}


def test_line_dedup_against_brute_force(spark, texts):
    found = {r.doc_id: r.text for r in queries.op2_line_dedup(spark, SF).select("doc_id", "text").collect()}
    assert found == expected_cuts(texts)


def test_chunks_shift_with_the_text():
    lines = [f"line {i} of a long passage with some words" for i in range(40)]
    for before in range(1, 6):
        text = "\n".join([f"own start {k}" for k in range(before)] + lines).encode()
        bodies = {b"\n".join(text.split(b"\n")[a:b]) for a, b in line_dedup.chunks(text)}
        plain = "\n".join(lines).encode()
        wanted = {b"\n".join(plain.split(b"\n")[a:b]) for a, b in line_dedup.chunks(plain)}
        assert len(wanted - bodies) <= 2


def test_passage_of_one_long_line_is_cut_once(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"start {i} here\n{passage}\nend {i} here") for i in range(5)]
    found = line_dedup.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found if passage in r.text) == [0]
    assert all(f"start {r.doc_id} here" in r.text and f"end {r.doc_id} here" in r.text for r in found)


def test_licence_accuracy_on_held_out_variations():
    rng = np.random.default_rng(99)
    background = [" ".join(rng.choice("the of and river stone walks under blue license plate terms".split(), 14)) for _ in range(400)]
    model = licences.train(background[:300])
    filler = "some other words around here that say nothing".split()
    right = total = 0
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            for text in licences._variations(notice, filler, 10, rng):
                found = model.judge(text)
                right += bool(found) and found[0] == family
                total += 1
    assert right / total > 0.9
    assert sum(model.judge(p) is not None for p in background[300:]) <= 2
    assert model.judge("This software is licensed under a proprietary license.")[0] == "unknown"
    assert all(model.judge(n)[3] for notices in licences.NOTICES.values() for n in notices)


def test_packing_round_trip(spark, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = defaultdict(list)
    pieces = queries.op4_packing(spark, SF).collect()
    for r in pieces:
        rows[r.doc_id].append(r)
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        at = 0
        for r in sorted(rows[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    lengths = Counter({(r.sequence_id, r.sequence_length) for r in pieces})
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for _, n in lengths)
    assert padding <= 0.02 * sum(n for _, n in lengths)


def test_cuts_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        window = 16
        gaps = [rng.randint(1, 7) for _ in range(rng.randint(1, 12))]
        at = [0, *itertools.accumulate(gaps)]
        fees = [0] + [rng.choice([0, 2, 5]) for _ in gaps]
        pad = lambda n: 0 if n & (n - 1) == 0 else window - n
        best = [0] + [10**9] * len(gaps)
        for j in range(1, len(at)):
            best[j] = min(best[i] + pad(at[j] - at[i]) + fees[j] for i in range(j) if at[j] - at[i] <= window)
        cuts = packing.choose_cuts(np.array(at), np.array(fees), window)
        assert cuts[-1] == len(gaps)
        assert sum(pad(at[b] - at[a]) + fees[b] for a, b in zip([0, *cuts], cuts)) == best[-1]


def test_words_encode_like_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    table = packing.WordTokens(tokenizer)
    rng = random.Random(5)
    letters = [*"abzAZéÉßµ'.,!?<|>&# \n\t\x1c\x85\xa0", "́", "Σ", "İ", "日", "<|endoftext|>", "'s", "don't", "word. "]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        ids = np.frombuffer(packing.encode(text.encode(), table)[0], dtype="<u4").tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_shards_are_near_equal(spark, texts):
    rows = queries.op5_sharding(spark, SF).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts.items()
    }
    sizes, places = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert max(sizes.values()) <= max(1.05 * sum(sizes.values()) / 40, max(r["size"] for r in rows))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_slot_map_moves_few_slots():
    weight = {(s, 0): 100 + s % 7 for s in range(8192)}
    first = sharding.SlotMap.first(list(weight), 40)
    grown = first.rebalanced(weight, 41)
    moved = sum(first.shard_of[k] != grown.shard_of[k] for k in weight)
    assert grown.version == 2 and moved <= 1.5 * len(weight) / 41
    totals = Counter()
    for k, s in grown.shard_of.items():
        totals[s] += weight[k]
    assert len(totals) == 41 and max(totals.values()) - min(totals.values()) <= 0.02 * max(totals.values())


def test_slot_map_versions_are_stored(spark, tmp_path):
    first = sharding.SlotMap.first([(s, 0) for s in range(10)], 3)
    first.store(spark, str(tmp_path))
    second = first.rebalanced({(s, 0): 1 + s for s in range(10)})
    assert second.store(spark, str(tmp_path)).count() == 10
    assert sorted(p.name for p in tmp_path.iterdir()) == ["version=1", "version=2"]


PAGE = """<html><head><title>T</title><style>p{margin:0}</style></head><body><h1>Head</h1><p>One <b>two<p>three<br>four
<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul><table><tr><th>k<th>value<tr><td>long key<td>1</table>
<div hidden>no</div><div style="display: none">no</div><p style="visibility:hidden">no <i style="visibility:visible">yes</i></p>
<pre>x  y
  z</pre><script>var a = "</p>";</script>end &amp; <!-- no --> more</body></html>"""


def test_layout():
    assert html_text.render(PAGE).split("\n") == [
        "Head", "", "One two", "", "three", "four", "", "- a", "- b", "  3. c", "  4. d", "",
        "k         value", "long key  1", "", "yes", "", "x  y", "  z", "", "end & more",
    ]


def test_all_text_of_any_markup_is_kept():
    rng = random.Random(2)
    tags = "<p> </p> <b> </b> <div> </div> <ul> <li> </ul> <table> <tr> <td> </td> </tr> </table> <ol> </ol> <td> <li> <h2> </h2> <dd> < <<".split()
    for _ in range(500):
        parts = [rng.choice(tags) if rng.random() < 0.7 else f" w{rng.randint(0, 99)} " for _ in range(rng.randint(0, 30))]
        wanted = Counter(re.findall(r"w\d+", " ".join(parts)))
        assert Counter(re.findall(r"w\d+", html_text.render("".join(parts)))) == wanted
    assert html_text.render("<div>" * 5000 + "deep") == "deep"


def test_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24))
    made = centres[rng.integers(0, 30, 4000)] + 0.7 * rng.normal(size=(4000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in ann.nearest(table, "vec_id % 20 = 0", sample_rows=2000).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 4000, 20):
        score = made @ made[q]
        score[q] = -np.inf
        hits += len({v for v, _ in found[q]} & set(np.argsort(-score)[:20].tolist()))
        assert len(found[q]) == 20
        assert all(abs(score[v] - s) < 1e-9 for v, s in found[q])
    assert hits / (200 * 20) >= 0.9


def test_partitions_are_balanced():
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(1000, 8))
    label = ann.balanced_partition(vectors, ann._neighbours(vectors, 10), 10)
    assert np.bincount(label, minlength=10).max() <= 106


def test_tables_find_links_of_a_chain_and_a_crowd(spark):
    """Near copies of one text whose links to each other are few, and a chain of small changes."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(200), 5):
            own[k] = f"own{i}x{k}"
        rows.append((i + 10, " ".join(own)))
    rows.append((500, " ".join(base)))
    chain = [f"c{i}" for i in range(200)]
    for step in range(12):
        chain[step * 15] = f"new{step}"
        rows.append((1000 + step, " ".join(chain)))
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, halves=10).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(198)} for i, t in rows}
    parent = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(parent, a), find(parent, b)))
            parent[high] = low
    assert found == {i: find(parent, i) for i in sets}


def find(parent: dict, x: int) -> int:
    while parent[x] != x:
        x = parent[x]
    return x


def test_blocks_of_a_cluster_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(40)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, halves=10)
    assert {r.component_id for r in found.collect()} == {0}


def test_components_against_brute_force(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(70)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test")).collect()
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((find(parent, a), find(parent, b)))
        parent[high] = low
    assert {r.node: r.component for r in found} == {x: find(parent, x) for e in edges for x in e if e[0] != e[1]}


def test_running_totals(spark):
    scratch = Scratch(spark, "test")
    rows = scratch.save(spark.range(0, 1000).select(F.col("id"), (F.col("id") % 5).alias("n")))
    found = {r.id: r.before for r in running_totals(rows, [F.col("id").desc()], "n", scratch).collect()}
    assert all(found[i] == sum(k % 5 for k in range(i + 1, 1000)) for i in range(1000))


def test_block_decisions_reach_aliases(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://good.org/x", '<link rel="canonical" href="http://bad.org/x">'),
            (2, "http://bad.org/x", ""),
            (3, "http://third.org/y#top", '<meta http-equiv=refresh content="0; url=/z">'),
            (4, "http://third.org/z", "<link href='http://BAD.org/q' rel='alternate canonical'>"),
            (5, "http://fifth.org/", '<link rel="canonical" href="http://mixed.org/ok">'),
            (6, "http://fifth.org/2", '<link rel=canonical href="http://fifth.org/">'),
            (7, "http://bad.org/mixed", '<link rel="canonical" href="http://fifth.org/2">'),
            (8, "http://alone.org/", "<!-- <link rel=canonical href=http://bad.org/> -->"),
            (9, "http://moved.org/", ""),
        ],
        "page_id long, url string, html string",
    )
    rules = spark.createDataFrame([("bad.org", "/", "block"), ("mixed.org", "/ok", "allow")], "host string, path string, verdict string")
    redirects = spark.createDataFrame([("http://moved.org/", "http://bad.org/x")], "u string, v string")
    found = {r.page_id: r.verdict for r in url_rules.judge(pages, rules, redirects).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow", 9: "block"}


def test_pipeline_against_brute_force(spark, texts):
    """Each stage on what its predecessor kept, the last one's tokens in full."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, scratch = docs.columns, Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = scratch.save(stage(spark, docs, SF))
        after = docs.collect()
        assert docs.columns == columns
        if name == "quality rules":
            kept = {r.doc_id for r in quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
            assert {r.doc_id for r in after} == kept
        elif name == "line dedup":
            assert {r.doc_id: r.text for r in after} == expected_cuts({i: r.text for i, r in before.items()})
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "near-dedup":
            table = minhash._WordHashes()
            sets = {i: set(minhash.shingle_set(r.text.encode(), 5, table).tolist()) for i, r in before.items()}
            parent = {i: i for i in sets}
            for a, b in itertools.combinations(sorted(sets), 2):
                both = len(sets[a] & sets[b]) if sets[a] and sets[b] else 0
                if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(parent, a), find(parent, b)))
                    parent[high] = low
            assert {r.doc_id for r in after} == {i for i in sets if find(parent, i) == i}
        else:
            size = sum(len(r.text.split()) for r in before.values())
            assert abs(sum(len(r.text.split()) for r in after) - 1.5 * size) <= 25
            assert max(Counter(r.doc_id for r in after).values()) <= 2
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).agg(F.sum("length")).first()[0] == wanted
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == wanted


def test_longest_of_many_rules_on_one_host(spark):
    made = random.Random(3)
    paths = sorted({"/" + "".join(made.choice("ab/") for _ in range(made.randint(0, 6))) for _ in range(150)})
    rules = [(host, p, made.choice(["allow", "block"])) for host in ("x.org", "org", "a.x.org") for p in paths if made.random() < 0.6]
    rules += [("tie.org", "/", "block"), ("tie.org", "/", "allow"), ("none.org", None, "block"), (None, "/", "block")]
    urls = [(made.choice(["x.org", "a.x.org", "b.a.x.org", "y.org", "org", ""]), "/" + "".join(made.choice("ab/") for _ in range(8))) for _ in range(400)]
    urls += [("tie.org", "/q"), ("none.org", "/"), ("x.org", "")] + [("x.org", "/ab")] * 5

    def expected(host, path):
        labels = host.split(".")
        domains = {".".join(labels[i:]) for i in range(len(labels))} if host else set()
        fitting = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if h in domains and p is not None and path.startswith(p)]
        return max(fitting)[2:] if fitting else (None, None)

    table = spark.createDataFrame([(i, *u) for i, u in enumerate(urls)], "id int, host string, path string")
    found = url_rules.apply_rules(table, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert {r.id: (r.rule, r.rule_verdict) for r in found} == {i: expected(*u) for i, u in enumerate(urls)}
    assert len(found) == len(urls)
