"""Byte-pair merges of many words at once, in vectorised rounds over flat numpy arrays.

All words' symbols lie in one array.  A round finds the lowest pair rank of every word, merges all its
occurrences from the left, and now and then the array is compacted, until no pair remains.  That is what a priority queue
(lowest rank first, then leftmost) gives word by word: merging all occurrences at once is exact as long as no merge opens a pair that
ranks as low as the merged one; a word's occurrences behind such a merge wait for a later round.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

NO_RANK = np.iinfo(np.int32).max
_HASH = np.uint64(0x9E3779B97F4A7C15)


def held(key: str, make: Callable[[], Any]) -> Any:
    """A value of this Python process, made once for all its tasks.  Functions travel to executors by value, with
    globals of their own, so it is kept by a module that is not part of them."""
    kept = sys.modules.setdefault("_plumeline_held", types.ModuleType("_plumeline_held")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - upto + sizes, sizes)


def slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose rows' ``sizes`` sum up to about ``most``, or one larger row; null counts as 0."""
    upto = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(upto):
        before = upto[begin - 1] if begin else 0
        end = max(int(np.searchsorted(upto, before + most, "right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


class MergeTable:
    """What pairs of symbols make, and in what order: ``left, right, made`` symbols of each merge, and the rank of
    every symbol below ``end`` that is made (lower first)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, ranks: np.ndarray, end: int):
        self.pair, self.end = PairTable(left, right, made), end
        self.rank = np.full(end + 2, NO_RANK, dtype=np.int32)  # the last one answers for no pair, -1
        self.rank[made] = ranks

    def rounds(self, symbol: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merged symbols, their words' numbers, and the places of their first characters."""
        state = _Flat(self, symbol, np.repeat(np.arange(len(lengths)), lengths), np.arange(len(symbol)))
        done: list[tuple] = []
        while len(state.starts):
            least = np.minimum.reduceat(state.rank[:-1], state.starts)
            over = least == NO_RANK
            if state.dead + state.lengths[over].sum() > len(state.word) // 2 or over.all():
                finished, state = state.parted(over)
                done.append(finished)
                continue
            least[over] = -1
            state.merge_at(np.flatnonzero(state.rank[:-1] == np.repeat(least, state.lengths)))
        columns = [np.concatenate(c) for c in zip(*done)] if done else [symbol, lengths[:0], lengths[:0]]
        order = np.argsort(columns[1], kind="stable")
        return tuple(c[order] for c in columns)


class PairTable:
    """Symbol made of two symbols, -1 for none: an open-addressing hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        bits = max(int(len(left) * 6).bit_length(), 4)
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(self.size, -1, dtype=np.int64)
        self.made = np.full(self.size, -1, dtype=np.int32)
        keys, self.probes = self._keys(left, right), 0
        at = self._slots(keys)
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.made[at[put]] = keys[put], made[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, made, at = keys[rest], made[rest], (at[rest] + 1) % self.size

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _HASH) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._keys(left, right)
        at = self._slots(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.made[at], np.int32(-1))
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at_open = (at[open_] + 1) % self.size
            at[open_] = at_open
            held = self.keys[at_open]
            same = held == keys[open_]
            found[open_[same]] = self.made[at_open[same]]
            open_ = open_[~same & (held >= 0)]
        return found


class _Flat:
    """Symbols of words that still merge, in one flat array with links over merged ones.  The last slot ends every word; it makes
    nothing with any symbol."""

    def __init__(self, merges: MergeTable, symbol: np.ndarray, word: np.ndarray, place: np.ndarray):
        n = len(symbol)
        self.merges, self.word, self.place, self.dead = merges, word, place, 0
        self.symbol = np.append(symbol, np.int32(merges.end))
        self.alive = np.ones(n, dtype=bool)
        first = np.diff(word, prepend=-1) != 0
        self.starts = np.flatnonzero(first)
        self.lengths = np.diff(self.starts, append=n)
        self.previous = np.append(np.where(first, n, np.arange(-1, n - 1)), n)
        self.next = np.append(np.where(np.append(first[1:], True)[:n], n, np.arange(1, n + 1)), n)
        self.made = merges.pair(self.symbol, self.symbol[self.next])
        self.rank = merges.rank[self.made]

    def parted(self, over: np.ndarray) -> tuple[tuple, _Flat]:
        """Symbols of the words that are ``over``, and the others without the merged slots."""
        ended = np.repeat(over, self.lengths)
        out, on = self.alive & ended, self.alive & ~ended
        finished = (self.symbol[:-1][out], self.word[out], self.place[out])
        return finished, _Flat(self.merges, self.symbol[:-1][on], self.word[on], self.place[on])

    def merge_at(self, at: np.ndarray) -> None:
        """One round: of the pairs that begin at ``at``, equal in rank within a word, merge the leftmost ones that do not overlap,
        up to the first of a word whose merge opens a pair of that rank or a lower one."""
        merges, count = self.merges, np.arange(len(at))
        fresh = np.append(True, self.next[at[:-1]] != at[1:])
        at = at[(count - np.maximum.accumulate(np.where(fresh, count, 0))) % 2 == 0]
        merged, limit = self.made[at], self.rank[at]
        gone = self.next[at]
        behind, ahead = self.next[gone], self.previous[at]
        # Merged from left to right, the symbol ahead may be merged already, the one behind is not.
        ahead_symbol = self.symbol[ahead]
        touching = np.flatnonzero(behind[:-1] == at[1:]) + 1
        ahead_symbol[touching] = merged[touching - 1]
        left, right = merges.pair(ahead_symbol, merged), merges.pair(merged, self.symbol[behind])
        opens = np.minimum(merges.rank[left], merges.rank[right]) <= limit
        if opens.any():
            before = np.cumsum(opens) - opens
            first = np.flatnonzero(np.diff(self.word[at], prepend=-1))
            safe = before == np.repeat(before[first], np.diff(first, append=len(at)))
            at, merged, gone, behind, left, right = (x[safe] for x in (at, merged, gone, behind, left, right))
        self.symbol[at] = merged
        self.next[at] = behind
        self.previous[behind] = at
        self.previous[-1] = len(self.word)
        self.alive[gone] = False
        self.dead += len(at)
        self.made[gone] = -1
        self.made[at] = right
        ahead = self.previous[at]
        self.made[ahead] = left
        changed = np.concatenate([gone, at, ahead])
        self.rank[changed] = merges.rank[self.made[changed]]
