"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumeline.llm import ann, html_text, licences, line_dedup, minhash, mixing, packing, quality, sharding, url_rules

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PROSE = " ".join(f"word{i} walks {i * 7} steps." for i in range(40))
LONG = " ".join(f"w{i}" for i in range(60_000))
ROWS = [
    (1, PROSE, "en", "a", 1),
    (1, PROSE, "en", "a", 1),
    (2, PROSE, "en", None, 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "de", "b", 4),
    (None, PROSE + " more", "de", "b", 1),
    (None, None, None, None, None),
    (6, LONG, "en", "c", 1),
    (7, "one\ntwo", "", "", 1),
    (8, PROSE.replace("word7 ", "Word7 "), "en", "a", 1),
]
CLASHES = "size words copy removed _row _dropped rejected hash key part doc kept target before text_hash component h1 node finish".split()


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, SHAPE)
    return made.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


TEXT_OPERATORS = {
    "quality": quality.judge,
    "licences": licences.scan,
    "packing": lambda d: packing.pack(d, TOKENIZER),
    "sharding": sharding.shard,
    "mixing": mixing.taken_words,
    "minhash": minhash.near_duplicates,
    "keep_good": quality.keep_good,
    "lines": line_dedup.drop_repeated_chunks,
    "keep_first": minhash.keep_first,
    "mix": mixing.mix,
}


@pytest.mark.parametrize("name", sorted(TEXT_OPERATORS))
def test_empty_table(none, name):
    assert TEXT_OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("name", ["quality", "sharding", "mixing", "minhash", "lines"])
def test_every_row_is_answered(docs, name):
    assert TEXT_OPERATORS[name](docs).count() == len(ROWS)


@pytest.mark.parametrize("name", ["keep_good", "lines", "keep_first", "mix"])
def test_stages_return_the_columns(docs, name):
    assert TEXT_OPERATORS[name](docs).columns == docs.columns


def test_quality(docs):
    found = {(r.doc_id, r.n_words): r for r in quality.judge(docs).collect()}
    assert found[(1, 160)].kept and found[(2, 160)].kept
    assert found[(3, 0)].base_failed and found[(4, 0)].base_failed and found[(5, 0)].base_failed
    assert not found[(6, 60_000)].base_failed
    assert {r.doc_id for r in quality.keep_good(docs).collect()} >= {1, 2, 8}


def test_minhash(docs):
    found = minhash.near_duplicates(docs).collect()
    by_id = {r.doc_id: (r.component_id, r.kept) for r in found}
    assert by_id[2] == (1, False) and by_id[8] == (1, False)
    assert [r.kept for r in found if r.doc_id == 1] == [True, True]
    assert by_id[3] == (3, True) and by_id[4] == (4, True) and by_id[6] == (6, True)
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert sorted(r.doc_id or 0 for r in minhash.keep_first(docs).collect()) == [0, 0, 1, 1, 3, 4, 5, 6, 7]


def test_packing(docs):
    pieces = packing.pack(docs, TOKENIZER).collect()
    assert sum(r.length for r in pieces if r.doc_id == 3) == 1 == sum(r.length for r in pieces if r.doc_id == 5)
    assert sum(r.length for r in pieces if r.doc_id == 1) == 2 * next(r.doc_tokens for r in pieces if r.doc_id == 1)
    assert max(r.sequence_length for r in pieces) <= 4096
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
    for found in by_sequence.values():
        at = 0
        for offset, length, total in sorted(found):
            assert offset == at
            at += length
        assert at == total


def test_sharding(docs):
    rows = sharding.shard(docs, shards=3).collect()
    places = {}
    for r in rows:
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert {r["size"] for r in rows if r.doc_id in (3, 4)} == {16}


def test_one_record_repeated_fills_all_shards(spark):
    rows = sharding.shard(spark.createDataFrame([(1, "same text", "en", "a", 9)] * 4000, SHAPE), shards=4)
    sizes = [r["b"] for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) < 0.2 * max(sizes)


def test_mixing(docs):
    rows = mixing.taken_words(docs).collect()
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * sum(r["size"] for r in rows)) <= 5
    again = mixing.taken_words(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    words = sum(len((r.text or "").split()) for r in mixing.mix(docs).select("text").collect())
    assert words == sum(r.taken for r in rows)


def test_lines(docs):
    kept = {(r.doc_id, r.source): r.text for r in line_dedup.drop_repeated_chunks(docs).collect()}
    assert kept[(1, "a")] == PROSE and kept[(2, None)] == "" and kept[(3, None)] is None
    assert kept[(6, "c")] == LONG and kept[(7, "")] == "one\ntwo"


def test_licences(spark):
    docs = spark.createDataFrame(
        [(1, "Intro.\nReleased under the MIT License.\n" + PROSE, "x"), (2, None, "x"), (None, "Licensed under CC BY-NC 4.0.", "x")],
        "doc_id long, text string, family string",
    )
    found = {(r.doc_id, r.paragraph): (r.family, r.confirmed) for r in licences.scan(docs).collect()}
    assert found == {(1, 1): ("mit", True), (None, 0): ("cc-by-nc", True)}


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "x"), (2, "", "", "x"), (None, "no scheme", "<p>a", "x"), (3, "http://A.Net/es/x?y#z", "<p>b<p>c", "x")],
        "page_id long, url string, html string, host string",
    )
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert texts == {1: None, 2: "", None: "a", 3: "b\n\nc"}
    rules = spark.createDataFrame([("net", "/es/", "block")], "host string, path string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    assert found[1] == ("", "", None, "allow") == found[2] == found[None]
    assert found[3] == ("a.net", "/es/x", "net/es/", "block")
    assert html_text.extract(pages.where("false")).count() == 0 == url_rules.judge(pages.where("false"), rules).count()


def test_vectors(spark):
    rows = [(i, [1.0, 0.0], "x") for i in range(30)] + [(30, [0.0, 1.0], "x"), (30, [0.0, 1.0], "x")]
    rows += [(31, None, "x"), (32, [0.0, 0.0], "x"), (33, [float("nan"), 1.0], "x"), (34, [None, 1.0], "x"), (35, [float("inf"), 1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, hash string")
    found = ann.nearest(table, "vec_id % 10 = 0", k=5).collect()
    by_query = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 10, 20, 30)}
    assert by_query == {0: [1, 2, 3, 4, 5], 10: [0, 1, 2, 3, 4], 20: [0, 1, 2, 3, 4], 30: [0, 1, 2, 3, 4]}
    assert ann.nearest(table.where("false"), "vec_id % 10 = 0").count() == 0
