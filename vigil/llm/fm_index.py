"""A compressed FM-index over integer symbols: BWT in a wavelet matrix, backward search on whole arrays of patterns."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling; ends when all ranks differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        if step < n:
            after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class Bits:
    """A bit vector of 64-bit words with a count of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank1(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Index of ``text`` (non-negative integers); 0 is a separator that no pattern holds.

    Separators must compare unequal to each other for the suffix order, so each gets a symbol of its
    own there; in the wavelet matrix they are one symbol."""

    def __init__(self, text: np.ndarray):
        text = text.astype(np.int64)
        ends = np.flatnonzero(text == 0)
        shifted = text + len(ends)
        shifted[ends] = np.arange(len(ends))
        order = suffix_array(shifted)
        seq = text[order - 1]  # the BWT; position -1 is the last symbol, a separator
        self.size = len(text)
        sigma = int(text.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.levels = []
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (seq >> bit) & 1 == 1
            zeros = int(len(seq) - ones.sum())
            self.levels.append((bit, Bits(ones), zeros))
            seq = np.concatenate((seq[~ones], seq[ones]))
        every = np.arange(sigma)  # where a symbol's suffixes begin, less where its run in the last level begins
        self.shift = self.first[:-1] - self._rank_from(every, np.zeros(sigma, dtype=np.int64))

    def _rank_from(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of ``at`` in the last level on the path of ``symbol``."""
        for bit, bits, zeros in self.levels:
            one = bits.rank1(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + one, at - one)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of ``symbol`` followed by what [low, high) stands for."""
        shift = self.shift[symbol]
        return self._rank_from(symbol, low) + shift, self._rank_from(symbol, high) + shift

    def repeated(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the runs text[start:start + length]: those that occur twice or more, and their intervals' low ends.

        All runs are extended backwards together; a run whose interval shrinks to itself alone has a
        matching statistic below ``length`` and goes no further."""
        last = text[starts + length - 1]
        low, high = self.first[last], self.first[last + 1]
        for j in range(length - 2, -1, -1):
            low, high = self.extend(text[starts + j], low, high)
            more = high - low > 1
            starts, low, high = starts[more], low[more], high[more]
        return starts, low
