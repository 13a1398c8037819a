"""A compressed FM-index over words, in numpy: suffix order, Burrows-Wheeler transform and a wavelet matrix.

Searches run for many patterns at once: one step extends all of them to the left by one word.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count for every 64, for the number of ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32 if len(bits) < 2**31 else np.int64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit vector for each bit of the symbols."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for shift in range(self.bits - 1, -1, -1):
            bit = (sequence >> shift) & 1
            self.levels.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.starts = np.zeros(symbols, np.int64)
        values, first = np.unique(sequence, return_index=True)
        self.starts[values] = first

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before the place given with it."""
        place = at
        for depth, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = level.ones(place)
            place = np.where((symbol >> (self.bits - 1 - depth)) & 1, zeros + ones, place - ones)
        return place - self.starts[symbol]


def suffix_order(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the ``depth`` (or more) symbols that follow, by prefix doubling."""
    rank, width = np.unique(sequence, return_inverse=True)[1].astype(np.int64), 1
    while width < depth:
        after = np.zeros(len(rank), np.int64)
        after[:-width or None] = rank[width:] + 1
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Over a sequence of symbols from 0 to ``symbols`` - 1; patterns of up to ``longest`` symbols can be found.

    The sequence ends with symbol 0, which no pattern has. The order looks one symbol further than the longest
    pattern, which is all that backward search relies on.
    """

    def __init__(self, sequence: np.ndarray, symbols: int, longest: int):
        self.order = suffix_order(sequence, longest + 1)
        self.matrix = WaveletMatrix(sequence[self.order - 1], symbols)
        counts = np.bincount(sequence, minlength=symbols)
        self.first = np.cumsum(counts) - counts

    def intervals(self, patterns: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``patterns`` the places in ``order`` it starts at, as an interval.

        A pattern whose interval falls under ``least`` places is given up with an empty one.
        """
        n, length = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, len(self.order), np.int64)
        live = np.arange(n)
        for step in range(length - 1, -1, -1):
            symbol = patterns[live, step]
            base = self.first[symbol]
            low[live] = base + self.matrix.rank(symbol, low[live])
            high[live] = base + self.matrix.rank(symbol, high[live])
            few = high[live] - low[live] < least
            low[live[few]] = high[live[few]] = 0
            live = live[~few]
            if not len(live):
                break
        return low, high
