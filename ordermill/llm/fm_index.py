"""A compressed full-text index over word codes: Burrows-Wheeler transform in a wavelet matrix (numpy)."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count of ones before every word of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))

    def ones(self, end: np.ndarray) -> np.ndarray:
        """Ones among the first `end` bits, for each end."""
        word = end >> 6
        mask = (np.uint64(1) << (end & 63).astype("<u8")) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search for patterns of up to `depth` symbols in a sequence of codes from 0.

    Suffixes are sorted by their first `depth` symbols at least, which is all that the search for such patterns needs.
    """

    def __init__(self, codes: np.ndarray, depth: int) -> None:
        rank, reach = codes.astype(np.int64), 1
        while reach < depth:
            after = np.append(rank[reach:], np.full(min(reach, len(rank)), -1))[: len(rank)]
            rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after + 1, return_inverse=True)[1]
            reach *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        transform = codes[self.suffixes - 1]  # the first suffix is preceded by the last symbol
        symbols = int(codes.max(initial=0)) + 1
        self.levels = list(range(max(1, (symbols - 1).bit_length()) - 1, -1, -1))
        self.vectors, self.zeros = [], []
        rest = transform
        for level in self.levels:
            bits = (rest >> level & 1).astype(np.uint8)
            self.vectors.append(BitVector(bits))
            self.zeros.append(len(bits) - int(bits.sum()))
            rest = np.concatenate([rest[bits == 0], rest[bits == 1]])
        counts = np.bincount(codes, minlength=symbols)
        every = np.arange(symbols)
        self.offset = np.cumsum(counts) - counts - self._descend(every, np.zeros(symbols, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, vector, zeros in zip(self.levels, self.vectors, self.zeros, strict=True):
            ones = vector.ones(place)
            place = np.where(symbol >> level & 1, zeros + ones, place - ones)
        return place

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the range bound `place` goes when `symbol` is put in front."""
        return self.offset[symbol] + self._descend(symbol, place)

    def search(self, patterns: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the rows of `patterns`; a pattern is given up (0, 0) once it has fewer than `least` occurrences."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.suffixes), dtype=np.int64)
        going = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[going, column]
            low[going], high[going] = self.step(symbol, low[going]), self.step(symbol, high[going])
            lost = high[going] - low[going] < least
            low[going[lost]] = high[going[lost]] = 0
            going = going[~lost]
        return low, high
