"""Minimal perfect hashes of sets of 64-bit keys, and count vectors indexed by them.

Keys are hashed to a bit array; those that are alone at their bit are placed, the others go on to the next, smaller
array. The rank of a key's bit among all set bits is its number, so n keys get the numbers 0 to n - 1. The keys
themselves lie beside the hash: a lookup verifies them, so a key outside the set is found to be foreign.
"""

from __future__ import annotations

import numpy as np

_LEVEL = np.uint64(0x9E3779B97F4A7C15)


def mix(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit keys (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _LEVEL * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys; -1 for keys that are not among them."""

    def __init__(self, keys: np.ndarray, spread: float = 2.0):
        keys = np.unique(np.asarray(keys, np.int64))
        self.n = len(keys)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (bits, rank before every 64 bits)
        left, placed = keys, 0
        while len(left):
            size = (int(len(left) * spread) // 64 + 1) * 64
            at = (mix(left, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((words, placed + np.cumsum(ones) - ones))
            placed += int(ones.sum())
            left = left[~alone[at]]
        self.keys = np.empty(self.n, np.int64)
        self.keys[self._place(keys)] = keys

    def _place(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (words, ranks) in enumerate(self.levels):
            if not len(left):
                break
            at = mix(keys[left], level) % np.uint64(len(words) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            own = words[word]
            is_set = (own >> bit & np.uint64(1)).astype(bool)
            below = own & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[is_set]] = (ranks[word] + np.bitwise_count(below).astype(np.int64))[is_set]
            left = left[~is_set]
        return found

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.int64)
        found = self._place(keys)
        near = found >= 0
        near[near] = self.keys[found[near]] == keys[near]
        return np.where(near, found, -1)
