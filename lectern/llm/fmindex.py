"""A succinct index of word sequences: the Burrows-Wheeler transform of their words in a wavelet matrix.

Backward search narrows an interval of sorted suffixes by one word a step. Here all
queries of a shard step together, one numpy operation for all of them. Suffixes are
sorted by their first 64 words only; intervals of patterns up to that length are those
of the full order.
"""

from __future__ import annotations

import numpy as np

#: Words by which suffixes are sorted.
DEPTH = 64

_MASKS = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Wavelet:
    """Ranks of symbols in a sequence: one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.sums, self.zeros = [], [], []
        for level in range(self.levels):
            on = (symbols >> (self.levels - 1 - level)) & 1 == 1
            packed = np.packbits(on, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            self.bits.append(packed)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64)]))
            self.zeros.append(int(len(on) - on.sum()))
            symbols = np.concatenate([symbols[~on], symbols[on]])
        self.start = self._walk(np.zeros(sigma, np.int64), np.arange(sigma))

    def _walk(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            on = (symbol >> (self.levels - 1 - level)) & 1 == 1
            word = at >> 6
            ones = self.sums[level][word] + np.bitwise_count(self.bits[level][word] & _MASKS[at & 63])
            at = np.where(on, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol[j] stands before position at[j]."""
        return self._walk(at, symbol) - self.start[symbol]


class FMIndex:
    """Index of sequences of symbols from 1 on, each followed by the separator 0.

    ``window`` (at most DEPTH) is the length of match that is looked for.
    """

    def __init__(self, sequence: np.ndarray, window: int):
        self.window = window
        n = len(sequence)
        ranks = sequence.astype(np.int64)
        held = {1: ranks}
        length = 1
        order = np.argsort(ranks, kind="stable")
        while length < DEPTH:
            later = np.zeros(n, np.int64)
            later[: max(0, n - length)] = ranks[length:] + 1
            key = ranks * (int(ranks.max(initial=0)) + 2) + later
            order = np.argsort(key)
            ordered = key[order]
            ranks = np.empty(n, np.int64)
            ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])[:n]
            length *= 2
            held[length] = ranks
        self.order = order
        self.n = n
        self.sigma = int(sequence.max(initial=0)) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=self.sigma))])
        self.wavelet = Wavelet(sequence[order - 1], self.sigma)
        self._held = held
        self.short = self._classes(window - 1)
        self.full = self._classes(window)
        del self._held

    def _classes(self, length: int) -> np.ndarray:
        """Bounds, in the sorted order, of the groups of suffixes that share their first ``length`` words."""
        base = max(k for k in self._held if k <= max(1, length))
        ranks = self._held[base]
        later = np.full(self.n, -1, np.int64)
        shift = max(0, length - base)
        later[: self.n - shift] = ranks[shift:]
        a, b = ranks[self.order], later[self.order]
        new = np.ones(self.n + 1, bool)
        new[1:-1] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return np.flatnonzero(new)

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least of values[position] over each group of suffixes that share their first ``window`` words."""
        return np.minimum.reduceat(values[self.order], self.full[:-1]) if self.n else values

    def matches(self, sequence: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Matching statistics, cut at ``window``, of query sequences that the index holds, read backwards.

        Yields (query numbers, first positions of the windows, groups as in ``full``), step by step.
        """
        group_of_short = np.repeat(np.arange(len(self.short) - 1), np.diff(self.short))
        group_of_full = np.repeat(np.arange(len(self.full) - 1), np.diff(self.full))
        by = np.argsort(starts - ends, kind="stable")
        ends, sizes = ends[by], (ends - starts)[by]
        lo, hi = np.zeros(len(by), np.int64), np.full(len(by), self.n, np.int64)
        for step in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-sizes, -step, "right"))
            ends, lo, hi, by, sizes = ends[:live], lo[:live], hi[:live], by[:live], sizes[:live]
            at = ends - step
            symbol = sequence[at]
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(self.before[symbol], 2)
            lo, hi = both[:live], both[live:]
            if step >= self.window:
                yield by, at, group_of_full[lo]
            if step >= self.window - 1:  # keep the first window - 1 words of the match for the next step
                group = group_of_short[lo]
                lo, hi = self.short[group], self.short[group + 1]
