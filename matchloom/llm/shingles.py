"""Sets of hashed word shingles, for many texts at a time."""

from __future__ import annotations

import numpy as np

#: Words of a shingle.
SIZE = 5

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
BYTE[65:91] = BYTE[97:123]  # A-Z count as a-z
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
POWERS = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64, kept between calls."""
    if len(POWERS[base]) < n:
        row = np.full(max(n, 1 << 16), base, np.uint64)
        row[0] = 1
        POWERS[base] = np.cumprod(row)
    return POWERS[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    Words are runs of other bytes than space and \\t to \\r, A-Z lower-cased. A text of fewer than five
    words, but not none, is one shingle; null and empty texts have none.
    """
    data = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
    space = SPACE[data]
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * powers(BASE, len(data)))))
    words = mix((total[ends] - total[starts]) * powers(INVERSE, len(data))[starts])
    joined = words[: max(0, len(words) - SIZE + 1)].copy()
    for i in range(1, SIZE):
        joined = mix(joined) + words[i : len(joined) + i]
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))).tolist()
    out = []
    for begin, end in zip(first, first[1:]):
        if end - begin >= SIZE:
            out.append(np.unique(joined[begin : end - SIZE + 1]))
        elif end > begin:
            short = np.uint64(end - begin)
            whole = np.full(1, short)
            for word in words[begin:end]:
                whole = mix(whole) + word
            out.append(mix(whole))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
