"""A compressed full-text index over numbers: wavelet levels of packed bits, searched backwards.

The index holds no suffix array, only the Burrows-Wheeler text as one bit vector for each
bit of a symbol, with a count for every 64 bits. Suffixes are sorted by their first
``depth`` symbols, which is exact for patterns of up to that length.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector that counts its ones before any place."""

    def __init__(self, bits: np.ndarray):
        whole = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        whole[: len(bits)] = bits
        self.words = np.packbits(whole, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(ones[:-1], dtype=np.int32))).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """A sequence of numbers below ``2 ** bits`` that counts the occurrences of a number before any place."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            zeros = np.flatnonzero(bit == 0)
            self.levels.append((shift, Bits(bit), len(zeros)))
            symbols = np.concatenate((symbols[zeros], symbols[bit == 1]))
        # Where each number's block begins below the last level.
        self.start = self._down(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def count(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, at) - self.start[symbols]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in order of their first ``depth`` symbols; equal ones by their place."""
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        if step >= depth:
            return np.argsort(rank, kind="stable")
        behind = np.zeros_like(rank)
        behind[:-step or None] = rank[step:]
        key = rank * (int(rank.max()) + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([True], np.diff(key[order]) != 0))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new)
        step *= 2


class FMIndex:
    """An index over numbers; 0 is left for separators."""

    def __init__(self, text: np.ndarray, depth: int):
        text = np.append(text, 0)
        order = suffix_order(text, depth)
        largest = int(text.max(initial=0))
        self.size = len(text)
        self.wavelet = Wavelet(text[order - 1], max(1, largest.bit_length()))
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with a symbol more at their front."""
        first = self.smaller[symbols]
        return first + self.wavelet.count(symbols, low), first + self.wavelet.count(symbols, high)

    def statistics(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """For each end: the number of symbols before it, up to ``most``, that occur at least ``least`` times,
        and where the interval of those symbols begins.

        All ends go backwards together; one that occurs too rarely leaves.
        """
        length, begin = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        left = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for back in range(1, most + 1):
            left, low, high = (x[ends[left] >= back] for x in (left, low, high))
            low, high = self.step(text[ends[left] - back], low, high)
            stay = high - low >= least
            left, low, high = left[stay], low[stay], high[stay]
            if not len(left):
                break
            length[left], begin[left] = back, low
        return length, begin
