"""Column-wise construction of the Burrows-Wheeler transform and common prefixes of a collection of byte strings.

A symbol is a word of several bytes, and a string is read at every shift of a word, so that each of its positions starts
one suffix; that needs as many fewer rounds as a word has bytes.  Readings are aligned at their ends.  Each round inserts
one more symbol of every reading that is long enough: the suffix that grows by this symbol gets its place among all
suffixes so far, from the transform alone, and the longest common prefixes with its new neighbours follow from those of
the shorter suffixes.  The transform is kept as its inverse: for each symbol the ascending list of rows that it precedes
(as one sorted column of symbol and row), so the rank of a symbol is a search in its list.

Each round reads the old columns from front to back in blocks and writes new ones.  Collections above ``in_memory``
symbols keep the columns in files of the task's temporary folder, which are removed when the construction ends.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

BLOCK = 1 << 20
_ROW = np.int64(0xFFFFFFFF)


def word_bytes(length: int) -> int:
    """Bytes of a symbol for strings of this length: the largest number up to 8 that divides it."""
    return max(w for w in range(1, 9) if length % w == 0)


def readings(strings: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Symbols of all readings, string by string and shift by shift, with the string and the shift of each."""
    out, owner, shift = [], [], []
    for i, s in enumerate(strings):
        raw = np.frombuffer(s, np.uint8)
        n = len(raw) - width + 1
        if n > 0:
            words = np.zeros(n, np.uint64)
            for k in range(width):
                words = (words << np.uint64(8)) | raw[k : k + n]
            for o in range(min(width, n)):
                out.append(words[o::width])
                owner.append(i)
                shift.append(o)
    return out, np.array(owner, np.int64), np.array(shift, np.int64)


class Collection:
    """The suffixes of all readings in order: ``lists`` (symbol and row of the next shorter suffix), ``common`` prefixes."""

    def __init__(self, strings: list[bytes], width: int = 1, in_memory: int = 1 << 26):
        self.strings, self.width = [len(s) for s in strings], width
        parts, self.owner, self.shift = readings(strings, width)
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self._files = None if self.lengths.sum() <= in_memory else tempfile.TemporaryDirectory(prefix="bwt-")
        self._made = 0
        n = len(parts)
        flat = np.unique(np.concatenate(parts), return_inverse=True)[1].astype(np.int64) if n else np.zeros(0, np.int64)
        ends = np.cumsum(self.lengths)
        # Rows 0..n-1 are the empty suffixes, in the order of the readings; symbols count from 1.
        self.lists, self.common = self._column(n, np.int64), self._column(n, np.int16)
        self.lists[:], self.common[:] = np.arange(n), 0
        self.row = np.arange(n)  # of the longest suffix of each reading so far
        for turn in range(1, int(self.lengths.max(initial=0)) + 1):
            active = np.flatnonzero(self.lengths >= turn)
            self._insert(active, flat[ends[active] - turn] + 1)

    def _column(self, rows: int, kind) -> np.ndarray:
        if self._files is None or rows == 0:
            return np.empty(rows, kind)
        self._made += 1
        return np.memmap(os.path.join(self._files.name, str(self._made)), kind, "w+", shape=(rows,))

    def close(self) -> None:
        """Remove the files; the columns of a collection in files end with them."""
        if self._files is not None:
            self.lists = self.common = None
            self._files.cleanup()

    def _insert(self, active: np.ndarray, symbols: np.ndarray) -> None:
        rows = len(self.lists)
        new = (symbols << 32) | self.row[active]
        order = np.argsort(new)
        active, new = active[order], new[order]
        symbols, tails = new >> 32, new & _ROW
        place = np.searchsorted(self.lists, new)
        # Rows of the shorter suffixes of both neighbours: old ones, or ones that this round inserts beside it.
        left, right = np.append(self.lists, -1)[place - 1], np.append(self.lists, -1)[place]
        before = np.where((left >= 0) & (left >> 32 == symbols), left & _ROW, -1)
        twin = np.concatenate([[False], symbols[1:] == symbols[:-1]])
        before = np.where(twin, np.maximum(before, np.concatenate([[-1], tails[:-1]])), before)
        follows = np.concatenate([place[1:] != place[:-1], [True]])  # else the next new row comes between
        after = np.where(follows & (right >= 0) & (right >> 32 == symbols), right & _ROW, rows)
        fresh = np.zeros(len(new), np.int64)
        has = np.flatnonzero(before >= 0)
        fresh[has] = 1 + self._least(before[has], tails[has])
        touched = np.flatnonzero(after < rows)
        changed = 1 + self._least(tails[touched], after[touched])

        shift = np.cumsum(np.bincount(place, minlength=rows + 1)[:rows], dtype=np.int64)  # new rows at or before each row
        target = place + np.arange(len(active))
        lists, common = self._column(rows + len(active), np.int64), self._column(rows + len(active), np.int16)
        for lo in range(0, rows, BLOCK):
            at = np.arange(lo, min(rows, lo + BLOCK)) + shift[lo : lo + BLOCK]
            part = self.lists[lo : lo + BLOCK]
            lists[at] = part + shift[part & _ROW]
            common[at] = self.common[lo : lo + BLOCK]
        lists[target], common[target] = new + shift[tails], fresh
        common[target[touched] + 1] = changed
        self.row = self.row + shift[self.row]
        self.row[active] = target
        self._drop(self.lists, self.common)
        self.lists, self.common = lists, common

    @staticmethod
    def _drop(*columns) -> None:
        for c in columns:
            if isinstance(c, np.memmap):
                os.unlink(c.filename)

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least common prefix on the way from row ``low`` to row ``high``."""
        if not len(low):
            return low
        order = np.argsort(-low, kind="stable")
        ranges = np.empty(2 * len(low), np.int64)
        ranges[::2] = np.clip(low[order] + 1, 0, len(self.common) - 1)
        ranges[1::2] = high[order] + 1
        padded = self.common if ranges[1::2].max() < len(self.common) else np.append(self.common, np.int16(0))
        out = np.empty(len(low), np.int64)
        # Starts descend, so every second range is empty and costs one look.
        out[order] = np.minimum.reduceat(padded, ranges)[::2]
        return out

    def shared(self, length: int) -> list[np.ndarray]:
        """Of every string, which positions start a substring of this length that starts elsewhere in the collection too."""
        need = length // self.width
        long = np.append(self.common, np.int16(0)) >= need
        twin = long[:-1] | long[1:]
        sizes = np.maximum(0, np.array(self.strings, np.int64) - length + 1)
        begin = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), bool)
        rows, alive, position = self.row.copy(), np.flatnonzero(self.lengths >= need), 0
        while len(alive):
            out[begin[self.owner[alive]] + self.shift[alive] + self.width * position] = twin[rows[alive]]
            rows[alive] = self.lists[rows[alive]] & _ROW
            position += 1
            alive = alive[self.lengths[alive] - position >= need]
        return np.split(out, begin[1:]) if len(sizes) else []
