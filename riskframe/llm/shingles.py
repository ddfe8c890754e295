"""Sets of word shingles as 64-bit hashes, computed with array operations over whole slices of documents.

Words are maximal runs of bytes other than the six ASCII white-space ones, with A-Z lower-cased. A word's hash is a
polynomial of random byte values, a shingle's one of its words' hashes, both finished by a mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(977)
_ODD = np.uint64(1)
_BYTES = _RANDOM.integers(1, 2 ** 63, 256, dtype=np.uint64) << _ODD | _ODD
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _RANDOM.integers(1, 2 ** 63, 64, dtype=np.uint64) << _ODD | _ODD


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text)."""
    if not len(texts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    ends = ends - ends[0]
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    space = _SPACE[raw]
    begins = ~space
    fresh = space.copy()  # does a word begin after here
    fresh[1:] = space[:-1]
    fresh[0] = True
    fresh[ends[:-1][ends[:-1] < len(raw)]] = True
    at = np.flatnonzero(begins)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(fresh[at])
    sizes = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    powers = np.full(int(sizes.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes = mix(np.add.reduceat(_BYTES[raw[at]] * powers[place], first))
    owner = np.searchsorted(ends, at[first], side="right") - 1
    return hashes, np.bincount(owner, minlength=len(texts))[:len(texts)]


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The distinct shingles of ``words`` words of every text, sorted; a shorter text is one shingle, an empty none."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for place in range(words):
        rolled += hashes[place:place + len(rolled)] * _PLACES[place]
    rolled = mix(rolled)
    found = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        start = end - count
        if count >= words:
            found.append(np.unique(rolled[start:end - words + 1]))
        elif count:
            own = (hashes[start:end] * _PLACES[:count]).sum(dtype=np.uint64) + np.uint64(count)
            found.append(mix(np.array([own], np.uint64)))
        else:
            found.append(np.empty(0, np.uint64))
    return found
