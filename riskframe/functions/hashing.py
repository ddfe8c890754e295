"""Keyed hashes: the only source of randomness in the package.

A draw depends on a salt and a row key, never on the partition a row sits in,
so splits, folds and resamples are the same after a repartition or a retry.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, functions as F

HASH_RANGE = 4294967296  # 2 ** 32


def keyed_hash(salt: str | Column, key: Column) -> Column:
    """Integer in [0, 2**32) from the first 8 hex digits of md5('salt:key')."""
    prefix = salt.cast("string") if isinstance(salt, Column) else F.lit(salt)
    digest = F.md5(F.concat(prefix, F.lit(":"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def keyed_uniform(salt: str | Column, key: Column) -> Column:
    """Uniform double in [0, 1)."""
    return keyed_hash(salt, key) / F.lit(float(HASH_RANGE))


def mixed(numbers, seed: int):
    """NumPy: well-mixed unsigned 64-bit hashes of 64-bit numbers (the finalizer of splitmix64)."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = numbers.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_START = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]


def md5_heads(prefixes, suffixes):
    """NumPy: first 8 hex digits, as numbers, of the md5 of every prefix followed by every suffix (prefixes x suffixes).

    Both are sequences of bytes. What ``keyed_hash`` computes, for many draws of one row at once; messages of one block
    are hashed as arrays, longer ones by hashlib.
    """
    import numpy as np

    out = np.empty((len(prefixes), len(suffixes)), np.uint32)
    lengths = np.array([len(p) for p in prefixes], np.int64)
    most = max((len(s) for s in suffixes), default=0)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        if length + most > 55:
            for row in rows:
                out[row] = [int.from_bytes(hashlib.md5(prefixes[row] + s).digest()[:4], "big") for s in suffixes]
            continue
        ends = b"".join((bytes(length) + s + b"\x80").ljust(56, b"\0") + (8 * (length + len(s))).to_bytes(8, "little")
                        for s in suffixes)
        ends = np.frombuffer(ends, "<u4").reshape(-1, 16)
        for at in range(0, len(rows), 16):
            own = rows[at:at + 16]
            starts = np.frombuffer(b"".join(prefixes[r].ljust(64, b"\0") for r in own), "<u4").reshape(-1, 16)
            words = [starts[:, i, None] | ends[None, :, i] if starts[:, i].any() or ends[:, i].any() else None for i in range(16)]
            out[own] = _md5_first(words, (len(own), len(suffixes)))
    return out


def _md5_first(words, shape):
    """The first word of the md5 of blocks given as 16 arrays (None: zeros), its bytes read from the left."""
    import numpy as np

    a, b, c, d = (np.full(shape, v, np.uint32) for v in _START)
    f, low = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:  # d ^ (b & (c ^ d))
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif turn == 1:  # c ^ (d & (b ^ c))
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:  # c ^ (b | ~d)
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        word = words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[turn] % 16]
        np.add(f, a, out=f)
        np.add(f, np.uint32(_SINES[i]), out=f)
        if word is not None:
            np.add(f, word, out=f)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=low)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=f)
        np.bitwise_or(f, low, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    return (a + np.uint32(_START[0])).byteswap()
