"""SentencePiece rounds against the library itself."""

from __future__ import annotations

import hashlib
import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumeline.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OWN = pieces.model(MODEL)
PARTS = ["a", "b", "e", "t", "h", "in", "the", " ", "  ", "\n", "▁", "é", "日", "本", "🙂", "1", "0", "=", "==", "-", "\t"]
PARTS += ["́", "st", "ing", "ion", " " * 17, "\r\n", "<s>", "<0x0A>", "\x00", ".", "�"]


def ours(texts: list[str]) -> list[list[int]]:
    flat, counts = OWN.encode(texts)
    ends = counts.cumsum()
    return [flat[e - c : e].tolist() for e, c in zip(ends.tolist(), counts.tolist())]


def test_special_texts():
    texts = ["", " ", "  a", "a  b ", "a\nb", "▁x", "a▁▁b", "\x00z", "<s>", "﻿x", "\n", "\n\n a", "a \n b", " \n", "🙂"]
    texts += [" " * n + "x" for n in range(1, 70)] + ["x" + " " * n for n in range(1, 70)] + ["▁" * 333, "a" * 500]
    assert ours(texts) == LIBRARY.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), max_size=8))
def test_mixed_texts(texts):
    assert ours(texts) == LIBRARY.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    ids = LIBRARY.encode(text)
    assert ours([text]) == [ids]
    assert OWN.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(0, 31_999)), max_size=14))
def test_decode_any_ids(ids):
    assert OWN.decode(ids) == LIBRARY.decode(ids)


def test_long_words_are_not_quadratic():
    rng = random.Random(3)
    word = "".join(rng.choices("etaoinshrdlucmfw", k=200_000))
    spaces = " " * 500_000 + "x"
    began = time.time()
    found = ours([word, spaces])
    assert time.time() - began < 20
    assert found == LIBRARY.encode([word, spaces])


def test_merges_that_open_a_lower_pair():
    """Ranks: bc, abc, cd, ab; 'ab' opens 'abc' only where 'bc' is not merged first."""
    rng = random.Random(5)
    for _ in range(50):
        texts = ["".join(rng.choices("▁ abcdefst", k=rng.randint(1, 400))) for _ in range(20)]
        assert ours(texts) == LIBRARY.encode(texts)


def test_frames(spark):
    rows = [(1, "The quick\nbrown  fox"), (1, "The quick\nbrown  fox"), (2, None), (3, ""), (None, "🙂"), (4, "long " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "word": F.lit(7)})
    encoded = pieces.encode(docs, MODEL)
    assert encoded.columns == ["doc_id", "word", "ids"]
    decoded = pieces.decode(encoded, MODEL)
    got = sorted((r.doc_id or 0, r.text, r.ids) for r in decoded.collect())
    assert got == sorted((i or 0, t or "", LIBRARY.encode(t or "")) for i, t in rows)
    digests = {r.doc_id: r for r in pieces.digests(decoded).collect()}
    ids = LIBRARY.encode(rows[0][1])
    assert digests[1].n_tokens == len(ids)
    assert digests[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digests[1].decoded_sha256 == hashlib.sha256(rows[0][1].encode()).hexdigest()
    assert digests[2].ids_sha256 == digests[3].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_frame(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(docs, MODEL), MODEL).count() == 0


def test_refuses_other_models():
    with pytest.raises(Exception):
        pieces.PieceModel(public_tokenizers.path("word_bpe_49k.json"))
