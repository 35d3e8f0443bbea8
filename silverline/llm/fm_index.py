"""A compressed FM-index of word sequences: a wavelet matrix over the transformed text, searched backwards."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits packed into 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.packed = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.packed)
        self.before = np.zeros(len(ones), np.int32)
        np.cumsum(ones[:-1], out=self.before[1:], dtype=np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.packed[word] & low)


class WaveletMatrix:
    """Counts of any symbol before any position, one bit vector for each bit of the symbols."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for b in reversed(range(bits)):
            bit = (values >> b) & 1
            self.levels.append(BitVector(bit))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        start = np.zeros_like(at)
        for level, (vector, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            both = vector.rank(np.concatenate((start, at)))
            first, last = both[: len(at)], both[len(at) :]
            start = np.where(one, zeros + first, start - first)
            at = np.where(one, zeros + last, at - last)
        return at - start


class FMIndex:
    """Backward search over texts of words, for the runs of `window` words that they share with other texts.

    `symbols` has all texts one after the other, each followed by 0, words numbered from 1; `owners` the number that a
    text's words report. Suffixes are sorted by their first 64 words, which is enough for windows of up to 63.
    """

    def __init__(self, symbols: np.ndarray, owners: np.ndarray, window: int):
        if not 2 <= window < 64:
            raise ValueError("window must be from 2 to 63")
        n, self.window = len(symbols), window
        self.n = n
        rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        half, width = rank, 1
        while width < 64:
            if width == 32:
                half = rank
            later = np.zeros(n, np.int64)
            later[: max(0, n - width)] = rank[width:] + 1
            rank = np.unique(rank * (n + 2) + later, return_inverse=True)[1]
            width *= 2
        order = np.argsort(rank, kind="stable")
        last = symbols[order - 1]
        self.matrix = WaveletMatrix(last, max(1, int(symbols.max(initial=0)).bit_length()))
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=1))))
        self.group, self.lows = self._groups(symbols, half, order, window - 1)
        owner, starts = self._groups(symbols, half, order, window)
        self.owner_group = owner
        self.least = np.minimum.reduceat(owners[order], starts[:-1]) if n else owners

    @staticmethod
    def _groups(symbols, half, order, length) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes that agree in their first `length` words: the group at each place, and where groups begin."""
        n = len(order)
        if length <= 32:
            keys = [np.concatenate((symbols[k:], np.zeros(k, symbols.dtype))) for k in range(length)] if length < 32 else [half]
        else:
            shift = length - 32
            keys = [half, np.concatenate((half[shift:], np.full(shift, -1)))[:n]]
        new = np.ones(n, bool)
        if n:
            new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        return np.cumsum(new) - 1, np.append(np.flatnonzero(new), n)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with a symbol followed by what the given ones begin with."""
        known = (symbol > 0) & (symbol < len(self.smaller) - 1)
        safe = np.where(known, symbol, 0)
        ranks = self.matrix.rank(np.concatenate((safe, safe)), np.concatenate((low, high)))
        base = self.smaller[safe]
        low, high = base + ranks[: len(low)], base + ranks[len(low) :]
        return low, np.where(known, high, low)

    def least_owner(self, symbols: np.ndarray, first: np.ndarray, size: np.ndarray, none: int) -> np.ndarray:
        """For each word of the queries, the least owner of the window that starts there, or `none`.

        Query i has the `size[i]` words from `first[i]`. All queries move from their last window to their first at once, a symbol
        at a time: the matched length grows until it reaches the window or nothing is left. Then the window moves by one
        word, a full match keeping all but its last word, so that each further window takes a single step.
        """
        out = np.full(len(symbols), none, np.int64)
        lane = np.flatnonzero(size >= self.window)
        end, length = size.astype(np.int64).copy(), np.zeros(len(size), np.int64)
        low, high = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        while len(lane):
            at = first[lane] + end[lane] - 1 - length[lane]
            lo, hi = self.step(symbols[at], low[lane], high[lane])
            hit = lo < hi
            low[lane], high[lane] = lo, hi
            length[lane] += hit
            full = lane[hit & (length[lane] == self.window)]
            out[first[full] + end[full] - self.window] = self.least[self.owner_group[low[full]]]
            group = self.group[low[full]]
            low[full], high[full], length[full] = self.lows[group], self.lows[group + 1], self.window - 1
            lost = lane[~hit]
            low[lost], high[lost], length[lost] = 0, self.n, 0
            end[full] -= 1
            end[lost] -= 1
            lane = lane[end[lane] >= self.window]
        return out
