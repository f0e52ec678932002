"""Byte-pair merges of many pieces at once, in numpy.

Pieces of equal length stand in the columns of one table.  In every round each piece that can still merge does its first
merge of the lowest rank, as a tokenizer does one after the other, so after a round all of them are one symbol shorter.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

SLOTS = 1 << 18
# Pieces of a table: fewer of them cost more calls than they save memory.
AT_ONCE = 16384
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# A rank and a place below 1 << PLACE are one 32-bit number.
PLACE = 6
_NONE = np.int32((1 << 31 - PLACE) - 1)


class PairMerges:
    def __init__(self, bare: np.ndarray, last: np.ndarray, merges: Iterable[tuple[int, int, int]]):
        """Ids of the 256 bytes within a piece and at its end; ids (left, right, merged) by rank."""
        found = np.array(list(merges), np.int64).reshape(-1, 3)
        if len(found) >= _NONE:
            raise ValueError("too many merges")
        self.bare, self.last, self.into = bare.astype(np.int32), last.astype(np.int32), found[:, 2].astype(np.int32)
        size = max(SLOTS, 1 << (4 * len(found)).bit_length())
        self.shift, self.most = np.uint64(64 - (size.bit_length() - 1)), size - 1
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        keys = found[:, 0] << 32 | found[:, 1]
        rank, at = np.arange(len(keys)), self._slot(keys)
        while len(rank):  # the first one that finds a slot free takes it, others go on to the next slot
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.ranks[at[won]] = keys[rank[won]], rank[won]
            rest = np.ones(len(rank), bool)
            rest[won] = False
            rank, at = rank[rest], (at[rest] + 1) & self.most

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _SPREAD >> self.shift).view(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge; the largest number if there is none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        there = self.keys.take(at)
        out = np.where(there == keys, self.ranks.take(at), _NONE)
        other = np.flatnonzero((there != keys) & (there >= 0))
        while len(other):
            step = (at[other] + 1) & self.most
            at[other] = step
            there = self.keys.take(step)
            same = there == keys[other]
            out[other[same]] = self.ranks.take(step[same])
            other = other[~same & (there >= 0)]
        return out

    def merge(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most ``1 << PLACE`` bytes, one piece behind the other, and how many each has."""
        ids, counts = np.empty(len(data), np.int32), np.empty(len(start), np.int64)
        order = np.argsort(length, kind="stable")
        sizes, first = np.unique(length[order], return_index=True)
        for size, lo, hi in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            for at in range(lo, hi, AT_ONCE):
                pieces = order[at : min(hi, at + AT_ONCE)]
                self._table(data, start[pieces], size, pieces, ids, counts)
        first = np.repeat(start - (np.cumsum(counts) - counts), counts)
        return ids[first + np.arange(len(first))], counts

    def _table(self, data: np.ndarray, start: np.ndarray, size: int, pieces: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids of pieces of one size go to their starts, their numbers to ``counts``."""
        symbols = np.stack([(self.bare if c < size - 1 else self.last).take(data.take(start + c)) for c in range(size)])
        ranks = self.rank(symbols[:-1].reshape(-1), symbols[1:].reshape(-1)).reshape(size - 1, len(start))
        places = np.arange(size, dtype=np.int32)[:, None]
        while True:
            first = ((ranks << PLACE) + places[: size - 1]).min(0) if size > 1 else np.full(len(start), _NONE << PLACE)
            over = first >> PLACE == _NONE
            if over.any():
                done = np.flatnonzero(over)
                counts[pieces[done]] = size
                for c in range(size):
                    ids[start[done] + c] = symbols[c].take(done)
                on = np.flatnonzero(~over)
                if not len(on):
                    return
                symbols, ranks, first, start, pieces = symbols.take(on, 1), ranks.take(on, 1), first.take(on), start.take(on), pieces.take(on)
            at = first & ((1 << PLACE) - 1)
            merged, column = self.into.take(first >> PLACE), np.arange(len(at))
            size -= 1
            for c in range(size):
                np.copyto(symbols[c], symbols[c + 1], where=at < c)
            symbols = symbols[:size]
            symbols[at, column] = merged
            for c in range(size - 1):
                np.copyto(ranks[c], ranks[c + 1], where=at < c)
            ranks = ranks[: size - 1]
            behind, before = np.flatnonzero(at < size - 1), np.flatnonzero(at > 0)
            ranks[at[behind], behind] = self.rank(merged[behind], symbols[at[behind] + 1, behind])
            ranks[at[before] - 1, before] = self.rank(symbols[at[before] - 1, before], merged[before])
