"""FM-index over a sequence of small integers: wavelet-matrix ranks, backward search, sampled suffixes.

The sequence is a list of runs; no pattern spans two runs.  All searches are
vectorised: one call looks for every pattern at once.
"""

from __future__ import annotations

import numpy as np

_U64 = np.uint64


class BitVector:
    """Bits with constant-time rank: 64-bit blocks and the count before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(_U64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)))
        self.ones = int(self.before[-1])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        block = i >> 6
        mask = (_U64(1) << (i & 63).astype(_U64)) - _U64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.blocks[i >> 6] >> (i & 63).astype(_U64)) & _U64(1)


class WaveletMatrix:
    """Rank and access over symbols 0 .. 2^levels - 1."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels):
            bit = (symbols >> (levels - 1 - level)) & 1
            self.bits.append(BitVector(bit))
            self.zeros.append(len(bit) - self.bits[-1].ones)
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first i."""
        start = np.zeros_like(i)
        for level in range(self.levels):
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            a, b = self.bits[level].rank1(start), self.bits[level].rank1(i)
            start = np.where(one, self.zeros[level] + a, start - a)
            i = np.where(one, self.zeros[level] + b, i - b)
        return i - start

    def step(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and how often it is among the first i."""
        start, symbol = np.zeros_like(i), np.zeros_like(i)
        for level in range(self.levels):
            one = self.bits[level].get(i).astype(bool)
            a, b = self.bits[level].rank1(start), self.bits[level].rank1(i)
            start = np.where(one, self.zeros[level] + a, start - a)
            i = np.where(one, self.zeros[level] + b, i - b)
            symbol = symbol * 2 + one
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; every 0 (end of a run) counts as a symbol of its own."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())).astype(np.int64)
    width = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        rising = np.concatenate(([0], (np.diff(key[order]) != 0).cumsum()))
        rank = np.empty(n, np.int64)
        rank[order] = rising
        if rising[-1] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Index of ``text`` (symbols 1 .. alphabet; each run ends with a 0)."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = 16):
        self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]  # before the first symbol stands the last one, a 0
        counts = np.bincount(text, minlength=alphabet + 2)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.wavelet = WaveletMatrix(bwt, max(1, int(alphabet).bit_length()))
        starts = (order % sample == 0) | (bwt == 0)  # walks end before a run's first symbol
        self.marked = BitVector(starts)
        self.samples = order[starts]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range [lo, hi) of every pattern (a row of ``patterns``, its first ``lengths`` symbols)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        live = np.arange(len(patterns))
        for back in range(1, patterns.shape[1] + 1):
            live = live[(lengths[live] >= back) & (lo[live] < hi[live])]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back]
            base = self.before[symbol]
            lo[live] = base + self.wavelet.rank(symbol, lo[live])
            hi[live] = base + self.wavelet.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled suffix and add the steps."""
        at, steps, found = rows.copy(), np.zeros_like(rows), np.full(len(rows), -1)
        open_ = np.arange(len(rows))
        while len(open_):
            here = at[open_]
            hit = self.marked.get(here).astype(bool)
            done = open_[hit]
            found[done] = self.samples[self.marked.rank1(here[hit])] + steps[done]
            open_ = open_[~hit]
            symbol, rank = self.wavelet.step(at[open_])
            at[open_] = self.before[symbol] + rank
            steps[open_] += 1
        return found
