"""Compressed FM-index over word ids: bit-packed wavelet matrix of the Burrows-Wheeler transform.

Matching statistics are taken for a whole batch of places at a time; every step of the backward search is a handful of
NumPy operations over all places that are still open, so no place costs Python work of its own.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits in 64-bit words with a running count: 1.5 bits for each bit stored."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(counts[:-1], out=self.before[1:])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1
            one = bits.astype(bool)
            zeros = len(symbols) - int(one.sum())
            self.levels.append((shift, BitRank(bits.astype(np.uint8)), zeros))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        self.origin = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank1(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position ``at``."""
        return self._descend(symbol, at) - self.origin[symbol]


class FMIndex:
    """Index of passages, given as word ids from 1 up; id 0 closes each passage. ``owner`` numbers the passage of each place.

    Suffixes are sorted to ``depth`` words, which is enough for backward search of patterns up to that length. Kept are the
    bits of the wavelet matrix and, in the order of suffixes, the 32-bit numbers of their passages.
    """

    def __init__(self, ids: np.ndarray, sigma: int, depth: int, owner: np.ndarray):
        n = len(ids)
        rank, order, width = ids.astype(np.int64), None, 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - width)] = rank[width:] + 1
            key = rank * (int(rank.max(initial=0)) + 2) + ahead
            order = np.argsort(key, kind="stable")
            in_order = key[order]
            fresh = np.ones(n, bool)
            fresh[1:] = in_order[1:] != in_order[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            width *= 2
            if width >= depth or fresh.all():
                break
        self.depth = depth
        self.owner = owner[order].astype(np.int32)
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(ids, minlength=sigma), out=self.before[1:])
        self.bwt = WaveletMatrix(ids[order - 1], sigma)

    def matching_statistics(self, ids: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, low, high) for each place of the indexed text: the longest run of words, up to ``most``, that ends there and
        occurs elsewhere too, and the suffix interval of its occurrences (empty where not even the last word does).

        Each step extends all matches that are still open by one word to the left; a match ends where it would be left
        with its own occurrence alone, or at the beginning of its passage.
        """
        last = ids[ends]
        low, high = self.before[last], self.before[last + 1]
        alone = high - low < 2
        length = np.where(alone, 0, 1)
        high = np.where(alone, low, high)
        live = np.flatnonzero(~alone)
        for back in range(1, most):
            live = live[ends[live] >= back]
            symbol = ids[ends[live] - back]
            live, symbol = live[symbol > 0], symbol[symbol > 0]
            if not len(live):
                break
            a = self.before[symbol] + self.bwt.rank(symbol, low[live])
            b = self.before[symbol] + self.bwt.rank(symbol, high[live])
            more = b - a > 1
            live = live[more]
            low[live], high[live] = a[more], b[more]
            length[live] += 1
        return length, low, high

    def window_minimum(self, ids: np.ndarray, starts: np.ndarray, length: int, value: np.ndarray) -> np.ndarray:
        """For each window of ``length`` words, the least ``value`` (one for each passage) over all its occurrences, the largest
        integer where the matching statistic stays below ``length``: such a window occurs once."""
        matched, low, high = self.matching_statistics(ids, starts + length - 1, length)
        many = np.flatnonzero(matched >= length)
        out = np.full(len(starts), np.iinfo(np.int64).max)
        if len(many):
            # Equal windows have equal intervals and different ones disjoint intervals.
            left, back = np.unique(low[many], return_inverse=True)
            right = np.empty(len(left), np.int64)
            right[back] = high[many]
            bounds = np.stack([left, right], axis=1).ravel()
            in_order = np.append(value[self.owner], np.iinfo(np.int64).max)
            out[many] = np.minimum.reduceat(in_order, bounds)[::2][back]
        return out
