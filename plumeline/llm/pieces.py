"""SentencePiece encoding and decoding with vectorised merge rounds.

A byte-pair model merges, again and again, the adjacent pair whose joined piece scores highest, the leftmost
first.  No piece reaches from a word into the next one's space mark, so words are independent and each
distinct word of a batch is merged once, by the rounds of :mod:`plumeline.llm.merging`.
"""

from __future__ import annotations

import codecs
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.merging import MergeTable, held, ranges, slices

MARK = "▁"
# A task merges the distinct words of about so many bytes of text at a time.
BATCH_BYTES = 4 << 20
# and decodes about so many ids at a time.
BATCH_IDS = 200_000


class PieceModel:
    """Tables of a byte-pair SentencePiece model with byte fallback, spaces escaped, a space put in front, and no other
    normalisation; other models are refused."""

    def __init__(self, model_file: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = library.vocab_size()
        names = [library.id_to_piece(i) for i in range(size)]
        is_byte = [library.is_byte(i) for i in range(size)]
        silent = [library.is_control(i) or library.is_unknown(i) for i in range(size)]
        normal = {n: i for i, n in enumerate(names) if not (is_byte[i] or silent[i] or library.is_unused(i))}
        self._refuse_others(library, normal, sum(is_byte))

        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.decoded: list[bytes] = []
        for i, name in enumerate(names):
            if is_byte[i]:
                self.byte_ids[int(name[3:5], 16)] = i
            self.decoded.append(bytes([int(name[3:5], 16)]) if is_byte[i] else name.replace(MARK, " ").encode())
        self.silent = frozenset(i for i, s in enumerate(silent) if s)
        self.unknown = library.unk_id()
        self.is_byte = np.array(is_byte)

        # Characters that are no piece but lie in one have symbols of their own behind the pieces.
        self.size = size
        chars = {c: normal.get(c, -1) for c in sorted(set(chain.from_iterable(normal)))}
        for c in [c for c, i in chars.items() if i < 0]:
            chars[c] = size = size + 1
        self.other = size + 1
        self.char_symbol = np.full(sys.maxunicode + 1, self.other, dtype=np.int32)
        for c, symbol in chars.items():
            self.char_symbol[ord(c)] = symbol

        scores = np.array([library.get_score(i) for i in normal.values()])
        rank = dict(zip(normal.values(), np.unique(-scores, return_inverse=True)[1].tolist()))
        symbol_of = chars | normal
        made = [
            (symbol_of[name[:cut]], symbol_of[name[cut:]], i, rank[i])
            for name, i in normal.items()
            for cut in range(1, len(name))
            if name[:cut] in symbol_of and name[cut:] in symbol_of
        ]
        self.merges = MergeTable(*np.array(made, dtype=np.int64).reshape(-1, 4).T.astype(np.int32), end=size + 2)
        # Without a piece that holds a line break and more, lines are words of their own.
        self.lines_apart = not any("\n" in n and len(n) > 1 for n in normal)
        self.run = 0
        self.run = self._filled_run(normal)

    @staticmethod
    def _refuse_others(library, normal: dict[str, int], n_bytes: int) -> None:
        probe = " Å ﬁ  é　\t\nA "
        if n_bytes != 256 or library.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("not a model with byte fallback, a space in front and no other normalisation")
        if any(MARK in n.lstrip(MARK) for n in normal):
            raise ValueError("the model has pieces that reach over a space")

    def _filled_run(self, normal: dict[str, int]) -> int:
        """The length by which long runs of space marks may be cut: that of the longest run that is a piece, if
        all such pieces rank alike, so runs fill up from the left, and do so in that length.  Otherwise 0."""
        runs = {len(n): i for n, i in normal.items() if len(n) > 1 and not n.strip(MARK)}
        most = max(runs, default=0)
        if not most or len(set(self.merges.rank[list(runs.values())].tolist())) > 1:
            return 0
        ids, ends = self.merge(pa.array([" " * (n - 1) for n in range(1, 4 * most)]))
        found = [part.tolist() for part in np.split(ids, ends[:-1])]
        filled = all(found[n - 1] == [runs[most]] + found[n - 1 - most] for n in range(most + 1, 4 * most))
        return most if filled else 0

    def marked(self, text: str) -> str:
        """The text with its words parted by space marks.  A word stands for a mark and its characters, spaces for
        further marks ahead of them; behind a line break, which begins a word where no piece holds it, for its characters alone."""
        if not self.lines_apart:
            found = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
        elif "  " in text or MARK in text or " \n" in text or text[:1] in (" ", "\n"):
            found = re.findall(f"\n[^\n{MARK}]*|{MARK}+[^\n{MARK}]*", MARK + text.replace(" ", MARK))
        else:
            return text.replace("\n", " \n").replace(" ", MARK)
        return MARK.join(w if w[0] == "\n" and self.lines_apart else w[1:].replace(MARK, " ") for w in self._cut_runs(found))

    def _cut_runs(self, found: list[str]) -> Iterator[str]:
        for word in found:
            if self.run and word.startswith(MARK * (2 * self.run)):
                marks = len(word) - len(word.lstrip(MARK))
                cut = (marks // self.run - 1) * self.run
                yield from [MARK * self.run] * (cut // self.run)
                word = word[cut:]
            yield word

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words as :meth:`marked` parts them, one after the other, and where each word's ids end."""
        words = words.cast(pa.large_string())
        mark, nothing = (pa.scalar(x, pa.large_string()) for x in (MARK, ""))
        bare = pc.and_(pc.starts_with(words, "\n"), self.lines_apart)
        spelled = pc.binary_join_element_wise(pc.if_else(bare, nothing, mark), words, nothing)
        lengths = pc.utf8_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64)
        whole = pc.binary_join(pa.LargeListArray.from_arrays([0, len(spelled)], spelled), nothing)[0].as_py() if len(words) else ""
        chars = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        symbol, word, place = self.merges.rounds(self.char_symbol[np.where(chars == 32, ord(MARK), chars)], lengths)
        # Characters that are no piece become the ids of their bytes.
        raw_at = np.flatnonzero(symbol >= self.size)
        counts = np.ones(len(symbol), dtype=np.int64)
        code = chars[place[raw_at]]
        counts[raw_at] = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(counts)
        ids = np.repeat(symbol, counts)
        if len(raw_at):
            raw = np.frombuffer(code.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
            sizes = counts[raw_at]
            ids[ranges(ends[raw_at] - sizes, sizes)] = self.byte_ids[raw]
        return ids, ends[np.flatnonzero(np.diff(word, append=-1))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        parted = pc.split_pattern(pa.array([self.marked(t) for t in texts], pa.large_string()), MARK)
        words = parted.flatten().dictionary_encode()
        ids, ends = self.merge(words.dictionary)
        which = words.indices.to_numpy()
        sizes = np.diff(ends, prepend=0)[which]
        flat = ids[ranges(ends[which] - sizes, sizes)]
        totals = np.concatenate([[0], np.cumsum(sizes)])[parted.offsets.to_numpy()]
        counts = np.diff(totals)
        # An empty text has no mark put in front either.
        empty = np.array([not t for t in texts], dtype=bool)
        if empty.any():
            flat = flat[np.repeat(~empty, counts)]
            counts[empty] = 0
        return flat, counts

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: pieces joined, space marks as spaces but for one at the start, control ids silent, the unknown
        id as its sign, and bytes that are not UTF-8 as U+FFFD each."""
        if not self.silent.isdisjoint(ids):
            return self._decode_signs(ids)
        whole = b"".join(map(self.decoded.__getitem__, ids))
        if whole[:1] == b" " and not self.is_byte[ids[0]]:
            whole = whole[1:]
        return whole.decode("utf-8", "plumeline_each_byte")

    def _decode_signs(self, ids: list[int]) -> str:
        parts, run, begun = [], [], False
        for i in ids:
            if i in self.silent:  # bytes do not join over it
                parts.append(b"".join(run).decode("utf-8", "plumeline_each_byte"))
                parts.append(" \u2047 " if i == self.unknown else "")
                run, begun = [], begun or i == self.unknown
                continue
            part = self.decoded[i]
            if not begun and part[:1] == b" " and not self.is_byte[i]:
                part = part[1:]
            begun = True
            run.append(part)
        return "".join(parts) + b"".join(run).decode("utf-8", "plumeline_each_byte")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def model(model_file: str) -> PieceModel:
    """The model of this Python process, read once for all its tasks."""
    codecs.register_error("plumeline_each_byte", _each_byte)
    return held(model_file, lambda: PieceModel(model_file))


def encode(docs: DataFrame, model_file: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``column`` replaced by ``ids``, the array of the model's ids for the whole text.

    Nothing is put in front or behind, and nothing is sampled.  A null or empty text has no ids; bytes that are not
    UTF-8 count as U+FFFD.  Every row is answered in place, repeated ones too, without a shuffle; other columns stay as they are (one called
    like ``ids`` is replaced).  ``model_file`` must exist on every executor; a task holds the model's tables and the
    distinct words of about ``BATCH_BYTES`` of text, or of one longer text.
    """
    others = [f for f in docs.schema.fields if f.name not in (column, ids)]
    schema = T.StructType([*others, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_file)
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch[column]), BATCH_BYTES):
                texts = [(t.as_py() or b"").decode("utf-8", "replace") for t in part[column].cast(pa.binary())]
                flat, counts = pieces.encode(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(part[f.name] for f in others), lists], names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{column}`")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str, column: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with a column ``text``, what the model's ids stand for; a null array decodes to an empty text.  Other columns
    stay as they are, one called like ``text`` is replaced."""
    others = [f for f in encoded.schema.fields if f.name != text]
    schema = T.StructType([*others, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_file)
        for batch in batches:
            for part in slices(batch, pc.list_value_length(batch[column]), BATCH_IDS):
                texts = [pieces.decode(ids.as_py() or []) for ids in part[column]]
                yield pa.RecordBatch.from_arrays([*(part[f.name] for f in others), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*[F.col(f"`{f.name}`") for f in others]).mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of rows with ``ids`` and ``text``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
