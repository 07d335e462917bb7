"""Hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words in a row."""
    count = max(0, len(hashes) - n + 1)
    total = np.full(count, n, np.uint64)
    for k in range(n):
        total = mixed(total, hashes[k : count + k])
    return total


def mixed(total: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The hashes of sequences that go on by one element."""
    total = (total ^ following) * MIX
    return total ^ (total >> np.uint64(31))
