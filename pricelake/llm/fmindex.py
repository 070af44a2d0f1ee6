"""An FM-index over integer symbols, searched for many phrases at once.

The text is a sequence of symbols 1..alphabet with 0 as separator.  The index
is its suffix array's last column in a wavelet matrix (one bit plane per bit
of a symbol, with running counts, so a rank costs one lookup per bit) and the
suffix positions that are multiples of ``SAMPLE`` or follow a separator, so
that a walk to a sample never crosses one.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; a suffix that ends sorts first."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], np.diff(text[order]) != 0])) if n else []
    step = 1
    while n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[:max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        # only suffixes that still tie are sorted again, in place
        sorted_rank = rank[order]
        tied = np.zeros(n, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        members = order[at]
        order[at] = members[np.argsort(key[members], kind="stable")]
        k = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
        step *= 2
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int):
        """``text``: symbols 0..alphabet; it must end with a 0."""
        self.n = n = len(text)
        order = suffix_array(text)
        last = text[order - 1]  # the first suffix's is the text's last symbol
        self.bits = max(1, int(alphabet).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet + 1))])
        self.planes, self.zeros = [], []
        row = last
        for b in range(self.bits - 1, -1, -1):
            bit = (row >> b) & 1
            self.planes.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(n - self.planes[-1][-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        marked = (order % SAMPLE == 0) | (last == 0)
        self.marks = np.concatenate([[0], np.cumsum(marked, dtype=np.int32)])
        self.marked, self.samples = marked, order[marked]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[i] in the first at[i] rows of the last column."""
        lo, hi = np.zeros_like(at), at.copy()
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.planes[k]
            one = ((symbol >> b) & 1).astype(bool)
            lo1, hi1 = ones[lo], ones[hi]
            lo = np.where(one, self.zeros[k] + lo1, lo - lo1)
            hi = np.where(one, self.zeros[k] + hi1, hi - hi1)
        return hi - lo

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The last column at the given rows."""
        out = np.zeros_like(at)
        for k in range(self.bits):
            ones = self.planes[k]
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit == 1, self.zeros[k] + ones[at], at - ones[at])
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the phrases (equal length, one a row) by
        backward search."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the rows: back steps to a sampled suffix."""
        out, at, steps = np.empty(len(rows), np.int64), rows.astype(np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.marked[at]
            out[left[done]] = self.samples[self.marks[at[done]]] + steps
            left, at = left[~done], at[~done]
            if len(left):
                c = self.symbol(at)
                at = self.first[c] + self.rank(c, at)
            steps += 1
        return out
