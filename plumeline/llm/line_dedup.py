"""Removal of passages that repeat over the corpus, exact to the line.

A chunk is a least run of lines with ``PASSAGE`` words: from every line with words the shortest one
that starts there and the shortest one that ends there.  Both depend on their own lines alone, and together the chunks
inside a run of at least so many words cover all of its lines, so a line is cut exactly where it lies
in such a run that an earlier place has too.

Steps: (1) of every chunk the line of the least hash is its anchor; equal chunks have equal anchors, so
only chunks whose anchor line repeats are listed; (2) listed chunks are counted by a 128-bit hash, the first,
by document id, stays; (3) of every text a least cover of its cuts is compared with what
stays by bytes; a hash whose texts are not all the same is left alone.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.llm.common import Scratch

PASSAGE = 50


class _Lines:
    """Lines of a text and its chunks, ``[first, last)`` in order."""

    def __init__(self, text: bytes):
        self.text, self.lines = text, text.split(b"\n")
        counts = [len(line.split()) for line in self.lines]
        self.filled = [i for i, n in enumerate(counts) if n]
        before = [0, *accumulate(counts[i] for i in self.filled)]
        self.pairs: list[tuple[int, int]] = []  # over filled lines
        if before[-1] >= PASSAGE:
            found = set()
            for p in range(len(self.filled)):
                q = bisect_left(before, before[p] + PASSAGE, p + 1)
                if q < len(before):
                    found.add((p, q))
                if before[p + 1] >= PASSAGE:
                    found.add((bisect_right(before, before[p + 1] - PASSAGE) - 1, p + 1))
            self.pairs = sorted(found)
        self.chunks = [(self.filled[p], self.filled[q - 1] + 1) for p, q in self.pairs]
        self.starts = [0, *accumulate(len(line) + 1 for line in self.lines)] if self.pairs else []

    def body(self, first: int, last: int) -> bytes:
        return self.text[self.starts[first] : self.starts[last] - 1]

    def anchors(self) -> tuple[list[int], Counter]:
        """The anchor of every chunk, and how often each filled line occurs."""
        if not self.pairs:
            return [], Counter()
        hashes = [_signed(xxhash.xxh3_64_intdigest(self.lines[i])) for i in self.filled]
        return [min(hashes[p:q]) for p, q in self.pairs], Counter(hashes)

    def without(self, ranges: list[tuple[int, int]]) -> tuple[str, int, int]:
        """The text without these lines, and the lines and words taken out."""
        cut = set()
        for first, last in ranges:
            cut.update(range(first, last))
        kept = b"\n".join(line for i, line in enumerate(self.lines) if i not in cut)
        return kept.decode(), len(cut), sum(len(self.lines[i].split()) for i in cut)


def _signed(h: int) -> int:
    return h - (1 << 63)


def _hashed(body: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(body)
    return _signed(h >> 64), _signed(h & ((1 << 64) - 1))


def chunks(text: bytes) -> list[tuple[int, int]]:
    """``[first, last)`` lines of the chunks of a text, in order; they overlap."""
    return _Lines(text).chunks


def _candidates(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Number and bytes of every chunk."""
    lines = _Lines(text)
    for k, (a, b) in enumerate(lines.chunks):
        yield k, lines.body(a, b)


def cut_chunks(text: str, removed: set[int]) -> tuple[str, int, int]:
    """The text without the chunks of these numbers, and the lines and words taken out.  Lines
    of the same chunk where it stays, which one that overlaps it shares, stay."""
    lines = _Lines(text.encode())
    kept: dict[bytes, int] = {}
    ranges = []
    for k, (a, b) in enumerate(lines.chunks):
        if k in removed:
            ranges.append((max(a, kept.get(lines.body(a, b), 0)), b))
        else:
            kept.setdefault(lines.body(a, b), b)
    return lines.without(ranges)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("anchor", pa.int64()), ("times", pa.int32())])
    for batch in batches:
        rows = []
        for doc_id, text_hash, text in zip(
            batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist(), batch["text"].cast(pa.binary())
        ):
            found, times = _Lines(text.as_py() or b"").anchors()
            rows += [(doc_id, text_hash, h, times[h]) for h in set(found)]
        if rows:
            yield _table(rows, schema)


def _list_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "text_hash", "h1", "h2")] + [(n, pa.int32()) for n in ("chunk", "first", "last")]
    )
    for batch in batches:
        rows = []
        for doc_id, text_hash, text, listed in zip(
            batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist(), batch["text"].cast(pa.binary()), batch["listed"].to_pylist()
        ):
            lines, wanted = _Lines(text.as_py() or b""), set(listed)
            for k, (anchor, (a, b)) in enumerate(zip(lines.anchors()[0], lines.chunks)):
                if anchor in wanted:
                    rows.append((doc_id, text_hash, *_hashed(lines.body(a, b)), k, a, b))
        if rows:
            yield _table(rows, schema)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every text the fewest chunks that cover the lines of all its cuts."""
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "text_hash", "h1", "h2")] + [(n, pa.int32()) for n in ("chunk", "start", "last")]
    )
    for batch in batches:
        rows = []
        for doc_id, text_hash, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "text_hash", "found"))):
            found.sort(key=lambda f: f["start"])
            covered, k = 0, 0
            while k < len(found):
                covered = max(covered, found[k]["start"])
                best = None
                while k < len(found) and found[k]["start"] <= covered:
                    if best is None or found[k]["last"] > best["last"]:
                        best = found[k]
                    k += 1
                while best["last"] > covered:
                    rows.append((doc_id, text_hash, best["h1"], best["h2"], best["chunk"], best["start"], best["last"]))
                    covered = best["last"]
                    while k < len(found) and found[k]["start"] <= covered:
                        if found[k]["last"] > best["last"]:
                            best = found[k]
                        k += 1
        if rows:
            yield _table(rows, schema)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("body", pa.binary())])
    for batch in batches:
        found: dict[bytes, tuple[int, int]] = {}
        for text, listed in zip(batch["text"].cast(pa.binary()), batch["listed"].to_pylist()):
            lines = _Lines(text.as_py() or b"")
            bodies = (lines.body(*lines.chunks[k]) for k in set(listed))
            found.update({body: _hashed(body) for body in bodies})
        if found:
            yield _table([(*h, body) for body, h in found.items()], schema)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc`` as it is, the new ``text`` and what was cut."""
    for batch in batches:
        rows = [
            _Lines(text.encode()).without([(r["start"], r["last"]) for r in removed]) if removed else (text, 0, 0)
            for text, removed in zip(batch["text"].to_pylist(), batch["removed"].to_pylist())
        ]
        texts, lines, words = zip(*rows) if rows else ((), (), ())
        columns = [batch["doc"], pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(words, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "lines_out", "words_out"])


def rewritten(docs: DataFrame) -> DataFrame:
    """``doc`` (the other columns), ``text`` without repeated passages, and the counts
    ``lines_out, words_out`` of what was cut.

    ``docs`` needs ``doc_id`` (whole number) and ``text``.  All documents stay, even if nothing is left of their text; null
    and empty texts stay as they are.  The first of equal chunks is the one with the least
    ``(doc_id, text hash, chunk number)``, null ids first; rows that repeat both id and text
    are one document and keep the same chunks.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def with_texts(per_doc: DataFrame, *columns: str) -> DataFrame:
        same = named["doc_id"].eqNullSafe(per_doc["doc_id"]) & (named["text_hash"] == per_doc["text_hash"])
        # Both sides of the joins with texts grow with the corpus: never a broadcast.
        return named.join(per_doc.hint("merge"), same).select(named["doc_id"], named["text_hash"], "text", "listed").select(*columns)

    anchors = scratch.save(named.mapInArrow(_list_anchors, "doc_id long, text_hash long, anchor long, times int"))
    common = scratch.save(anchors.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"))
    per_doc = anchors.join(common, "anchor").groupBy("doc_id", "text_hash").agg(F.collect_set("anchor").alias("listed"))
    shape = "doc_id long, text_hash long, h1 long, h2 long, chunk int"
    listed = with_texts(per_doc, "doc_id", "text_hash", "text", "listed").mapInArrow(_list_chunks, f"{shape}, first int, last int")
    # Rows that repeat a document come to the same partition by the join.
    listed = scratch.save(listed.dropDuplicates(["doc_id", "text_hash", "chunk"]))
    repeated = scratch.save(
        listed.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "chunk", "last")).alias("keeper"))
        .where("n > 1")
    )
    # A chunk that overlaps the same one where it stays is cut behind that only.
    own = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash"))
    later = (
        listed.join(repeated.select("h1", "h2", "keeper"), ["h1", "h2"])
        .where(~(own & (F.col("chunk") == F.col("keeper.chunk"))))
        .withColumn("start", F.when(own, F.greatest("first", "keeper.last")).otherwise(F.col("first")))
    )
    found = later.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "last", "chunk", "h1", "h2")).alias("found"))
    cover = scratch.save(found.mapInArrow(_cover, f"{shape}, start int, last int"))

    # Byte comparison: the cover's chunks and those that stay, equal ones combined in each task.
    stay = repeated.join(cover.select("h1", "h2").distinct(), ["h1", "h2"]).select("keeper.doc_id", "keeper.text_hash", "keeper.chunk")
    per_doc = cover.select("doc_id", "text_hash", "chunk").union(stay).groupBy("doc_id", "text_hash").agg(
        F.collect_list("chunk").alias("listed")
    )
    bodies = with_texts(per_doc, "text", "listed").mapInArrow(_bodies, "h1 long, h2 long, body binary")
    variants = bodies.groupBy("h1", "h2", "body").count().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("texts"))
    equal = variants.where("texts = 1").select("h1", "h2")

    cuts = cover.join(equal, ["h1", "h2"]).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "last")).alias("removed"))
    cuts = scratch.save(cuts.select(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"), "removed"))
    others = F.struct(*[c for c in docs.columns if c != "text"])
    keyed = docs.select(others.alias("doc"), "text", F.xxhash64("text").alias("hash"))
    match = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("cut_id")) & (F.col("hash") == F.col("cut_hash"))
    joined = keyed.join(cuts.hint("merge"), match, "left").select("doc", "text", "removed")
    shape = f"doc {joined.schema['doc'].dataType.simpleString()}, text string, lines_out long, words_out long"
    return joined.mapInArrow(_rewrite, shape)


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with repeated passages cut out of ``text`` as in :func:`rewritten`."""
    return rewritten(docs).select(*["text" if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])
