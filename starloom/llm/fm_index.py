"""FM-index over a sequence of word ids, vectorised over many patterns.

The sequence holds symbols 1..s and separators (0). Suffixes are compared up
to their first separator and separators by position, so all suffixes differ.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; only suffixes still tied are sorted again.

    The last symbol must be a separator.
    """
    n = len(symbols)
    seps = symbols == 0
    first = symbols.astype(np.int64) + int(seps.sum())
    first[seps] = np.arange(int(seps.sum()))
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    starts = np.r_[True, sorted_first[1:] != sorted_first[:-1]]
    group = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    single = starts & np.r_[starts[1:], True]
    tied = order[~single]  # in the order of their ranks
    k = 1
    while len(tied):
        follow = rank[tied + k]  # a tied suffix has no separator in its first k symbols
        at = np.lexsort((follow, rank[tied]))
        tied, own, follow = tied[at], rank[tied][at], follow[at]
        new_own = np.r_[True, own[1:] != own[:-1]]
        new = new_own | np.r_[True, follow[1:] != follow[:-1]]
        place = np.arange(len(tied))
        begin = np.maximum.accumulate(np.where(new_own, place, 0))
        sub = np.maximum.accumulate(np.where(new, place, 0))
        rank[tied] = own + sub - begin
        tied = tied[~(new & np.r_[new[1:], True])]
        k *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


class BitRank:
    """Bits with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.r_[bits, np.zeros(64 - n % 64, bits.dtype)], bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Level-wise wavelet tree (zeros before ones on each level)."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.shifts = list(range(max(1, int(top).bit_length()) - 1, -1, -1))
        self.levels: list[tuple[BitRank, int]] = []
        rest = symbols
        for s in self.shifts:
            bits = ((rest >> s) & 1).astype(np.uint8)
            self.levels.append((BitRank(bits), int(len(bits) - bits.sum())))
            rest = np.concatenate([rest[bits == 0], rest[bits == 1]])
        every = np.arange(top + 1)
        self.begin = self._follow(every, np.zeros(top + 1, np.int64))

    def _follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for s, (bits, zeros) in zip(self.shifts, self.levels):
            ones = bits.ones(i)
            i = np.where((symbol >> s) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i``."""
        return self._follow(symbol, i) - self.begin[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            bit = bits.get(i).astype(bool)
            ones = bits.ones(i)
            symbol = symbol * 2 + bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i - self.begin[symbol]


class FMIndex:
    def __init__(self, symbols: np.ndarray, top: int):
        """``symbols`` (ids up to ``top``, 0 between and after the runs)."""
        sa = suffix_array(symbols)
        before = symbols[sa - 1]  # the last symbol, a separator, stands before the first
        self.tree = WaveletTree(before, top)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        # positions sampled every SAMPLE symbols, and at the start of each run
        sampled = (sa % SAMPLE == 0) | (before == 0)
        self.sampled, self.positions = BitRank(sampled.astype(np.uint8)), sa[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of equally long patterns (rows).

        Returns the numbers of the patterns that occur and their row ranges.
        """
        which = np.arange(len(patterns))
        last = patterns[:, -1]
        lo, hi = self.smaller[last], self.smaller[last + 1]
        for j in range(patterns.shape[1] - 1, -1, -1):
            if j < patterns.shape[1] - 1:
                c = patterns[which, j]
                lo, hi = self.smaller[c] + self.tree.rank(c, lo), self.smaller[c] + self.tree.rank(c, hi)
            there = lo < hi
            which, lo, hi = which[there], lo[there], hi[there]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by steps back to a sampled position."""
        out = np.full(len(rows), -1, np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            known = self.sampled.get(rows).astype(bool)
            out[open_[known]] = self.positions[self.sampled.ones(rows[known])] + steps
            open_, rows = open_[~known], rows[~known]
            symbol, rank = self.tree.access(rows)
            rows = self.smaller[symbol] + rank
            steps += 1
        return out
