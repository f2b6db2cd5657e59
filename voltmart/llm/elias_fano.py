"""Elias-Fano sequences as flat arrays, with searches over whole arrays of queries.

A non-decreasing sequence of n numbers below u keeps the low log2(u/n) bits of each number packed,
and the high parts as a bit vector in which the i-th number sets bit ``high + i``. All arrays are
views of one buffer, so a sequence can live in a memory-mapped file.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_WORD = np.uint64(64)


def _select_table() -> np.ndarray:
    """Place of the k-th set bit of a byte."""
    out = np.zeros((256, 8), np.uint8)
    for value in range(256):
        for k, place in enumerate(b for b in range(8) if value >> b & 1):
            out[value, k] = place
    return out


_BYTE_SELECT = _select_table()


def _u(x: int) -> np.uint64:
    return np.uint64(x)


_ONES, _TOPS = _u(0x0101010101010101), _u(0x8080808080808080)
_FIVES, _THREES, _NIBBLES = _u(0x5555555555555555), _u(0x3333333333333333), _u(0x0F0F0F0F0F0F0F0F)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Positions of the k-th (from 0) set bits, or clear bits if ``flip``; before: such bits up to each word."""
    w = np.searchsorted(before, k, side="right") - 1
    left = (k - before[w]).astype(np.uint64)
    bits = ~words[w] if flip else words[w]
    # Set bits up to and with each byte, all bytes of a word at a time.
    upto = bits - ((bits >> _ONE) & _FIVES)
    upto = (upto & _THREES) + ((upto >> _u(2)) & _THREES)
    upto = ((upto + (upto >> _u(4))) & _NIBBLES) * _ONES
    # Bytes that end at or before the bit asked for.
    byte = np.bitwise_count((((left * _ONES) | _TOPS) - upto) & _TOPS).astype(np.uint64) << _u(3)
    left -= ((upto << _u(8)) >> byte) & _u(255)
    cell = (bits >> byte) & _u(255)
    return w * 64 + (byte + _BYTE_SELECT.ravel()[((cell << _u(3)) | left).astype(np.int64)]).astype(np.int64)


def _next(words: np.ndarray, before: np.ndarray, at: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Positions of the k-th such bits, which are the first ones from ``at`` on."""
    w = at >> 6
    bits = (~words[w] if flip else words[w]) >> (at & 63).astype(np.uint64)
    out = at + np.bitwise_count((bits & (~bits + _ONE)) - _ONE)
    far = np.flatnonzero(bits == 0)
    if len(far):
        out[far] = _select(words, before, k[far], flip)
    return out


class EliasFano:
    def __init__(
        self, n: int, low_bits: int, top: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray | None = None, zeros: np.ndarray | None = None
    ):
        self.n, self.low_bits, self.top, self.low, self.high = n, low_bits, top, low, high
        if ones is None:
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])[:-1]
            zeros = np.arange(len(high), dtype=np.int64) * 64 - ones
        self.ones, self.zeros = ones, zeros

    @classmethod
    def flat(cls, values: np.ndarray) -> np.ndarray:
        """Header, sequence and directory in one array, which ``mapped`` reads without copies."""
        header, buffer = cls.build(values)
        e = cls.load(header, buffer)
        return np.concatenate([np.array(header, np.uint64), buffer, e.ones.view(np.uint64), e.zeros.view(np.uint64)])

    @classmethod
    def mapped(cls, flat: np.ndarray) -> EliasFano:
        n, bits, top, low, high = map(int, flat[:5])
        low_part, high_part, ones, zeros = np.split(flat[5:], np.cumsum([low, high, high]))
        return cls(n, bits, top, low_part, high_part, ones.view(np.int64), zeros.view(np.int64))

    @staticmethod
    def build(values: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Header and buffer of a non-decreasing sequence."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((top >> bits) // 64 + n // 64 + 3, np.uint64)
        if n:
            np.bitwise_or.at(high, at >> 6, _ONE << (at & 63).astype(np.uint64))
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            begin = np.arange(n, dtype=np.int64) * bits
            word, shift = begin >> 6, (begin & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > _WORD
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_WORD - shift[over]))
        return [n, bits, top, len(low), len(high)], np.concatenate([low, high])

    @classmethod
    def load(cls, header: list[int], buffer: np.ndarray) -> EliasFano:
        n, bits, top, low, high = header
        return cls(n, bits, top, buffer[:low], buffer[low : low + high])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        begin = i * self.low_bits
        word, shift = begin >> 6, (begin & 63).astype(np.uint64)
        out = self.low[word] >> shift
        spill = self.low[word + 1] << (np.uint64(63) - shift) << _ONE
        return (out | spill) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Numbers at positions ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (_select(self.high, self.ones, i, False) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def spans(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers at positions ``i`` and at the positions after them."""
        at = _select(self.high, self.ones, i, False)
        after = _next(self.high, self.ones, at + 1, i + 1, False)
        shift = np.uint64(self.low_bits)
        return tuple((((p - k).astype(np.uint64) << shift) | self._low(k)).astype(np.int64) for p, k in ((at, i), (after, i + 1)))

    def find(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """First position of each query, or -1 where it is absent; only inside begin..end if given."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        asked = np.flatnonzero(x <= np.uint64(self.top)) if self.n else np.zeros(0, np.int64)
        if not len(asked):
            return out
        q = x[asked]
        bucket = (q >> np.uint64(self.low_bits)).astype(np.int64)
        # Numbers with high part h lie between the (h-1)-th and the h-th clear bit.
        at = np.zeros(len(q), np.int64)
        later = np.flatnonzero(bucket)
        at[later] = _select(self.high, self.zeros, bucket[later] - 1, True) + 1
        lo, hi = at - bucket, _next(self.high, self.zeros, at, bucket, True) - bucket
        if begin is not None:
            lo, hi = np.maximum(lo, begin[asked]), np.minimum(hi, end[asked])
        want = q & np.uint64((1 << self.low_bits) - 1)
        stop = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        ok = lo < stop
        ok[ok] = self._low(lo[ok]) == want[ok]
        out[asked[ok]] = lo[ok]
        return out
