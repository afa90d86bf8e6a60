"""Order-preserving packing of token streams into fixed windows.

Documents stay in ``doc_id`` order.  The stream of a partition is cut into windows of
at most ``window`` tokens; a cut may fall behind a document (free), behind a
sentence (``SENTENCE_PENALTY``) or, inside a sentence longer than a window and near the end of a
partition, behind any token (``TOKEN_PENALTY``).  A dynamic programme over the cut places
minimises padding plus penalties.  As padding is ``window - length``, the best
predecessor of a place is the minimum of ``cost + position`` over the last ``window``
tokens, kept in a monotone queue; lengths that are powers of two have no padding and
are tried apart.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumeline.llm.merging import MergeTable, held, ranges, slices

WINDOW = 4096
END_ID = 2
SENTENCE_PENALTY = 4
TOKEN_PENALTY = 24
# A partition is solved in stretches of this many windows; the last quarter of a
# stretch is solved again with what follows.
HORIZON = 128
MAX_CACHED_WORDS = 200_000
MAX_CACHED_BYTES = 64
LETTERS_THEN_MARKS = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"
# A task encodes the words of about so many bytes of text at a time.
BATCH_BYTES = 4 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
)


class WordTokens:
    """Ids of white-space separated words.

    The tokenizer lower-cases, drops white space and never joins over it, nor over the end of a
    run of letters, so a text's ids are those of its words in turn, and those of a
    word of Western letters with ASCII marks behind it are those of both parts.  Letters are merged here, each distinct
    run of a batch once, in rounds; what else there is goes through the tokenizer and is remembered.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.others = tokenizer, {b"": b""}
        model = json.loads(tokenizer.to_str())["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [(vocab[a], vocab[b], vocab[a + b], rank) for rank, (a, b) in enumerate(merges)]
        if len({m[2] for m in made}) < len(made):
            raise ValueError("the tokenizer has tokens of several merges")
        self.merges = MergeTable(*np.array(made, dtype=np.int64).T.astype(np.int32), end=len(vocab))
        # Byte-level tokenizers write bytes that do not print as the characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        ends = model["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[names[b]] for b in range(256)], dtype=np.int32)
        self.last = np.array([vocab[names[b] + ends] for b in range(256)], dtype=np.int32)

    def letters(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of small letters, one after the other, and how many each has."""
        lengths = pc.binary_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = np.frombuffer(b"".join(runs.cast(pa.binary()).to_pylist()), dtype=np.uint8)
        symbols = self.inner[raw]
        last = np.cumsum(lengths)[lengths > 0] - 1
        symbols[last] = self.last[raw[last]]
        symbols, word, _ = self.merges.rounds(symbols, lengths)
        return symbols, np.bincount(word, minlength=len(runs))

    def rest(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any other parts of words, and how many each has."""
        named = parts.cast(pa.binary()).to_pylist()
        missing = [p for p in named if p not in self.others]
        if missing:
            if len(self.others) + len(missing) > MAX_CACHED_WORDS:
                self.others = {b"": b""}
            found = self.tokenizer.encode_batch([p.decode() for p in missing], add_special_tokens=False)
            fresh = {p: array("i", e.ids).tobytes() for p, e in zip(missing, found)}
            self.others.update((p, ids) for p, ids in fresh.items() if len(p) <= MAX_CACHED_BYTES)
        else:
            fresh = {}
        ids = [fresh[p] if p in fresh else self.others[p] if p in self.others else self._alone(p) for p in named]
        return np.frombuffer(b"".join(ids), dtype="<i4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _alone(self, part: bytes) -> bytes:
        return array("i", self.tokenizer.encode(part.decode(), add_special_tokens=False).ids).tobytes()

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        split = pc.extract_regex(words, LETTERS_THEN_MARKS)
        plain = pc.is_valid(split)
        nothing = pa.scalar("", words.type)
        stems = pc.utf8_lower(pc.if_else(plain, pc.struct_field(split, "letters"), nothing)).dictionary_encode()
        tails = pc.if_else(plain, pc.struct_field(split, "marks"), words).dictionary_encode()
        tables = []
        for part, ids_of in ((stems, self.letters), (tails, self.rest)):
            ids, sizes = ids_of(part.dictionary)
            which = part.indices.to_numpy()
            tables.append((ids, (np.cumsum(sizes) - sizes)[which], sizes[which]))
        # Of every word first the letters' ids, then the others'.
        starts = np.stack([tables[0][1], tables[1][1] + len(tables[0][0])], axis=1).ravel()
        sizes = np.stack([tables[0][2], tables[1][2]], axis=1)
        return np.concatenate([tables[0][0], tables[1][0]])[ranges(starts, sizes.ravel())], sizes.sum(axis=1)


def encode_batch(texts: list[bytes], table: WordTokens, end_id: int = END_ID) -> Iterator[tuple[bytes, np.ndarray]]:
    """For every document its little-endian ids with the end id, and the token positions behind its sentences
    and lines (the last one is the document's end)."""
    words: list[bytes] = []
    upto: list[list[int]] = []  # words up to the end of every sentence
    for text in texts:
        for mark in (b".", b"!", b"?"):
            text = text.replace(mark + b" ", mark + b"\n")
        ends = []
        for sentence in text.split(b"\n"):
            words += sentence.split()
            ends.append(len(words))
        upto.append(ends)
    try:
        named = pa.array(words, pa.large_binary()).cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        named = pa.array([w.decode("utf-8", "replace") for w in words], pa.large_string())
    coded = named.dictionary_encode()
    ids, sizes = table.words(coded.dictionary)
    which = coded.indices.to_numpy()
    sizes_here = sizes[which]
    flat = ids[ranges((np.cumsum(sizes) - sizes)[which], sizes_here)].astype("<u4").tobytes()
    tokens = np.concatenate([[0], np.cumsum(sizes_here)])
    close, before = end_id.to_bytes(4, "little"), 0
    for sentences in upto:
        ends = tokens[sentences] - before
        total = int(ends[-1])
        # No cut between the last sentence and the end id.
        ends = np.append(ends, total + 1)
        ends[-2] = total + 1
        yield flat[4 * before : 4 * (before + total)] + close, ends
        before += total


def encode(text: bytes, table: WordTokens, end_id: int = END_ID) -> tuple[bytes, np.ndarray]:
    """:func:`encode_batch` of one document."""
    return next(encode_batch([text], table, end_id))


def choose_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW, shortest: int = 1) -> list[int]:
    """Indices into ``places`` (rising, from 0 to the stream's end, never more than
    ``window`` apart) of the cheapest cuts, the end included.  Lengths of a power of two from
    ``shortest`` on count as unpadded."""
    at, fees = places.tolist(), penalties.tolist()
    unpadded: dict[int, list[int]] = {}  # places a power of two ahead
    for power in (1 << k for k in range(window.bit_length()) if shortest <= 1 << k < window):
        ahead = np.searchsorted(places, places - power)
        for j in np.flatnonzero(places[ahead] == places - power).tolist():
            unpadded.setdefault(j, []).append(int(ahead[j]))
    cost, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(at[0], 0)])  # (cost + position, place), rising
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - window:
            queue.popleft()
        value, best = queue[0]
        value += window - here
        for i in unpadded.get(j, ()):
            if cost[i] < value:
                value, best = cost[i], i
        value += fees[j]
        cost[j], back[j] = value, best
        value += here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def _places(ends: np.ndarray, fees: np.ndarray, total: int, window: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cut places of a stretch: sentence and document ends, every ``window // 2`` tokens
    of a longer gap and, in the last stretch, multiples of 16 over its last window."""
    gaps = np.diff(ends, prepend=0)
    extra = [np.arange(e - g + window // 2, e, window // 2) for e, g in zip(ends[gaps > window // 2], gaps[gaps > window // 2])]
    if last:
        extra.append(total - np.arange(16, min(total, window), 16))
    more = np.unique(np.concatenate(extra)) if extra else np.empty(0, dtype=np.int64)
    more = more[~np.isin(more, ends)]
    all_ends = np.concatenate([ends, more])
    order = np.argsort(all_ends, kind="stable")
    all_fees = np.concatenate([fees, np.full(len(more), TOKEN_PENALTY)])
    return np.concatenate([[0], all_ends[order]]), np.concatenate([[0], all_fees[order]])


class _Packer:
    """Documents of one partition, in order, to pieces.  Holds at most ``HORIZON`` windows
    and one document."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.docs: deque = deque()  # [doc_id, ids, ends, tokens before the stretch]
        self.held = 0

    def add(self, doc_id, ids: bytes, ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append([doc_id, ids, ends, 0])
        self.held += len(ids) // 4
        if self.held >= HORIZON * self.window:
            yield from self.solve(last=False)

    def solve(self, last: bool) -> Iterator[tuple]:
        if not self.held:
            return
        places, fees, base = [], [], 0
        for _, ids, ends, done in self.docs:
            left = np.unique(ends[ends > done])
            fee = np.full(len(left), SENTENCE_PENALTY)
            fee[-1] = 0
            places.append(left - done + base)
            fees.append(fee)
            base += len(ids) // 4 - done
        points, costs = _places(np.concatenate(places), np.concatenate(fees), base, self.window, last)
        cuts = points[choose_cuts(points, costs, self.window, 1 if last else self.window // 8)].tolist()
        if not last:
            limit = base - HORIZON * self.window // 4
            cuts = [c for c in cuts if c <= limit]
        before = 0
        for cut in cuts:
            yield from self._emit(cut - before)
            before = cut

    def _emit(self, length: int) -> Iterator[tuple]:
        offset = 0
        self.held -= length
        while offset < length:
            doc = self.docs[0]
            doc_id, ids, _, done = doc
            total = len(ids) // 4
            take = min(total - done, length - offset)
            crc = zlib.crc32(memoryview(ids)[4 * done : 4 * (done + take)])
            yield doc_id, done, take, crc, total, self.sequence, offset, length
            offset += take
            doc[3] = done + take
            if doc[3] == total:
                self.docs.popleft()
        self.sequence += 1


def _pack_partition(tokenizer_file: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held(f"words {tokenizer_file}", lambda: WordTokens(Tokenizer.from_file(tokenizer_file)))
        packer = _Packer(window, TaskContext.get().partitionId() << 40)
        schema = pa.schema(
            [pa.field("doc_id", pa.int64())]
            + [pa.field(f.split()[0], pa.int64()) for f in PIECES.split(", ")[1:]]
        )

        def table_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

        rows: list[tuple] = []
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch["text"]), BATCH_BYTES):
                texts = [text.as_py() or b"" for text in part["text"].cast(pa.binary())]
                for doc_id, encoded in zip(part["doc_id"].to_pylist(), encode_batch(texts, table, end_id)):
                    rows.extend(packer.add(doc_id, *encoded))
                if len(rows) >= 5000:
                    yield table_of(rows)
                    rows = []
        rows.extend(packer.solve(last=True))
        if rows:
            yield table_of(rows)

    return run


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_length``.

    ``docs`` needs ``doc_id, text``; other columns are ignored.  A null or empty text is
    its end id alone; a null ``doc_id`` packs first.  Ties and repeated rows are packed
    each, in the order of the text's hash; an empty table gives no rows.  Documents are range-partitioned on id, text hash and
    row position, so a repeated id is spread as well; each task streams its
    documents and holds ``HORIZON`` windows.  Lost tasks are repeated with the same order.
    ``tokenizer_file`` must exist on every executor.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = named.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    keys = ["doc_id", "_hash", "_row"]
    ordered = named.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return ordered.mapInArrow(_pack_partition(tokenizer_file, window, end_id), PIECES)
