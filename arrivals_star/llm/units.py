"""Token ids of recurring text units (words), each spelled out once.

Tokenisers that never join text across a blank give a unit the same ids wherever it stands. A store
keeps the ids of units met so far, found by a 128-bit hash in a direct-mapped table; what is not
found is handed to the tokeniser once per slice. The store is bounded: it is emptied when full, and
a unit pushed out of its place in the table is simply encoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from arrivals_star.llm import spans

U64 = np.uint64
SLICE = 1 << 21
TABLE_BITS = 19
MOST_IDS = 1 << 23


class UnitStore:
    def __init__(self, dtype=np.uint16):
        self.dtype = dtype
        self.hashers = (spans.SpanHash(61), spans.SpanHash(67))
        self._clear()

    def _clear(self) -> None:
        self.tab1, self.tab2 = np.zeros((2, 1 << TABLE_BITS), U64)
        self.tab_row = np.full(1 << TABLE_BITS, -1, np.int64)
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.rows = 0

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> int:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(lengths) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        first = self.rows
        self.flat[self.used:self.used + len(flat)] = flat
        self.starts[first:first + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:first + len(lengths)] = lengths
        self.used += len(flat)
        self.rows += len(lengths)
        return first

    def ids(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units buf[starts:ends], end to end, and the number of ids of each.

        ``encode(at)`` gives the same two arrays for the units numbered ``at``.
        """
        if self.used > MOST_IDS:
            self._clear()
        h1, h2 = (h(buf, starts, ends) for h in self.hashers)
        slot = (h1 & U64((1 << TABLE_BITS) - 1)).astype(np.int64)
        row = self.tab_row[slot]
        miss = np.flatnonzero((row < 0) | (self.tab1[slot] != h1) | (self.tab2[slot] != h2))
        if len(miss):
            order = np.lexsort((h2[miss], h1[miss]))
            a, b = h1[miss][order], h2[miss][order]
            new = np.ones(len(miss), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = miss[order[new]]
            first = self._append(*encode(at))
            row[miss[order]] = first + np.cumsum(new) - 1
            self.tab1[slot[at]], self.tab2[slot[at]] = h1[at], h2[at]
            self.tab_row[slot[at]] = np.arange(first, self.rows)
        lengths = self.lengths[row]
        return self.flat[spans.ragged(self.starts[row], lengths)], lengths


def slices(buf: np.ndarray, offsets: np.ndarray, blank: np.ndarray):
    """(first document, byte range, document bounds) of slices of about SLICE bytes.

    Slices hold whole documents; a longer document is cut before blanks, so that no unit is cut.
    Its parts come as slices of one document each.
    """
    d, n = 0, len(offsets) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + SLICE, "right")) - 1)
        lo, hi = int(offsets[d]), int(offsets[e])
        if e == d + 1 and hi - lo > SLICE:
            while hi - lo > SLICE:
                # before a blank that follows a character that is none
                at = lo + SLICE
                while at < hi and not (blank[buf[at]] and not blank[buf[at - 1]]):
                    at += 1
                yield d, lo, at, np.array([0, at - lo])
                lo = at
            if lo == hi:  # no blank to cut before: the last part was the rest of the document
                d = e
                continue
        yield d, lo, hi, (offsets[d:e + 1] - lo if e > d + 1 or lo == offsets[d] else np.array([0, hi - lo]))
        d = e
