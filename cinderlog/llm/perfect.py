"""Minimal perfect hashing of sets of numbers, and lookups that verify their keys.

Level by level the keys left over are hashed to twice as many bits as there are keys; those alone on their bit are
placed there, and a key's index is the number of set bits before its own. About four bits a key are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPARE = 2
_MIX = np.uint64(0xD6E8FEB86659FD93)
_ODD = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    values = values.astype(np.uint64) * np.uint64(_ODD) + np.uint64((seed + 1) * _ODD & (1 << 64) - 1)
    values = (values ^ values >> np.uint64(32)) * _MIX
    values = (values ^ values >> np.uint64(32)) * _MIX
    return values ^ values >> np.uint64(32)


@dataclass(frozen=True)
class PerfectHash:
    """Bits of all levels as 64-bit words, the words at which levels end, and the set bits before each word."""

    words: np.ndarray
    ends: tuple[int, ...]
    before: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        """The hash of different keys."""
        levels: list[np.ndarray] = []
        left = np.asarray(keys)
        while len(left):
            size = -(-SPARE * len(left) // 64)
            at = (mixed(left, len(levels)) % np.uint64(64 * size)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return PerfectHash.from_words(
            np.concatenate(levels) if levels else np.zeros(0, np.uint64), tuple(np.cumsum([len(x) for x in levels]).tolist())
        )

    @staticmethod
    def from_words(words: np.ndarray, ends: tuple[int, ...]) -> PerfectHash:
        set_bits = np.bitwise_count(words).astype(np.int64)
        return PerfectHash(words, ends, np.cumsum(set_bits) - set_bits)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """A different index from 0 for each key of the set; for other keys any index, or -1."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        begin = 0
        for level, end in enumerate(self.ends):
            if not len(left):
                break
            at = (mixed(keys[left], level) % np.uint64(64 * (end - begin))).astype(np.int64)
            word, bit = begin + (at >> 6), (at & 63).astype(np.uint64)
            here = self.words[word]
            hit = (here >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(here & (np.uint64(1) << bit) - np.uint64(1)).astype(np.int64)
            found[left[hit]] = (self.before[word] + below)[hit]
            left, begin = left[~hit], end
        return found
