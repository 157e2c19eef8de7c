"""Character shingles as numbers: a polynomial hash over code points, for whole arrays of places at once."""

from __future__ import annotations

import numpy as np

# Modulus and base of the shingle hash. The base is below 2^31, so
# that (modulus - 1) * base fits in 63 bits, also in SQL.
HASH_PRIME = 4_294_967_291
HASH_BASE = 1_540_483_477
# A second pair; both together name a shingle in 64 bits.
OTHER_PRIME = 4_294_967_279
OTHER_BASE = 1_812_433_253


def code_points(text: str) -> np.ndarray:
    """Code points plus one, so that no character counts as nothing."""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)


def rolling_hash(points: np.ndarray, ngram: int, base: int = HASH_BASE, prime: int = HASH_PRIME) -> np.ndarray:
    """Hash of the ``ngram`` points from every place on: sum of point * base^(places behind it), modulo ``prime``."""
    n = max(0, len(points) - ngram + 1)
    total = np.zeros(n, np.uint64)
    for i in range(ngram):
        total += points[i : i + n] * np.uint64(pow(base, ngram - 1 - i, prime))
        if i % 1024 == 1023:  # terms have at most 53 bits
            total %= np.uint64(prime)
    return total % np.uint64(prime)


def shingle_names(text: str, ngram: int) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit names; the whole text if it is shorter, also if empty."""
    points = code_points(text)
    if len(points) == 0:
        return np.zeros(1, np.uint64)
    size = min(ngram, len(points))
    high, low = rolling_hash(points, size), rolling_hash(points, size, OTHER_BASE, OTHER_PRIME)
    return np.unique(high << np.uint64(32) | low)
