"""Hashes of words and of windows of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 500_000

# Odd multipliers of the mixing step; one pair for each independent hash.
_ODD = [
    (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)),
    (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)),
]
_LAST = np.uint64(0xFF51AFD7ED558CCD)


class WordHashes(dict):
    """64-bit hash by word; forgets everything when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mix(left: np.ndarray, right: np.ndarray, which: int) -> np.ndarray:
    a, b = _ODD[which]
    x = left * a + (right ^ b) * b
    x ^= x >> np.uint64(32)
    x *= _LAST
    return x ^ (x >> np.uint64(29))


def window_hashes(h: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` words; a window is hashed from its two halves."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    if length == 1:
        return h
    half = length // 2
    part = window_hashes(h, half, which)
    n = len(h) - length + 1
    out = _mix(part[:n], part[half : half + n], which)
    if length % 2:
        out = _mix(out, h[length - 1 : length - 1 + n], which)
    return out
