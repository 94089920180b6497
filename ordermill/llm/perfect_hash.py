"""Minimal perfect hashing of 64-bit keys in levels of bit arrays (numpy)."""

from __future__ import annotations

import numpy as np

from ordermill.llm.fm_index import BitVector


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key."""
    with np.errstate(over="ignore"):
        h = keys ^ (np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Maps n distinct keys to 0 .. n - 1; any other key goes to one of these places or to -1.

    On each level a key that has its bit for itself stays; the others go on to the next, smaller level. A key's
    place is the number of set bits before its own, so a look-up takes constant time on average.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = [BitVector(np.unpackbits(words.view(np.uint8), bitorder="little")) for words in levels]
        self.sizes = [64 * len(words) for words in levels]
        counts = [int(np.bitwise_count(words).sum()) for words in levels]
        self.offsets = np.cumsum([0, *counts])[:-1].tolist()

    @staticmethod
    def build(keys: np.ndarray, spare: float = 2.0) -> list[np.ndarray]:
        """The words of each level for distinct keys."""
        levels = []
        while len(keys):
            if len(levels) == 64:
                raise ValueError("keys of a perfect hash must be distinct")
            size = 64 * int(np.ceil(len(keys) * spare / 64))
            place = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[place]]
        return levels

    def places(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, dtype=np.int64)
        open_keys = np.arange(len(keys))
        for level, (vector, size, offset) in enumerate(zip(self.levels, self.sizes, self.offsets, strict=True)):
            place = (mixed(keys[open_keys], level) % np.uint64(size)).astype(np.int64)
            bit = vector.words[place >> 6] >> (place & 63).astype("<u8") & np.uint64(1) == 1
            found[open_keys[bit]] = offset + vector.ones(place[bit])
            open_keys = open_keys[~bit]
        return found
