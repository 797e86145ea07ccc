"""Monotone sequences in Elias-Fano form, read in place from a buffer and queried for many values at once."""

from __future__ import annotations

import numpy as np

WORD = np.uint64(64)


def _at_bits(words: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bits from each start; the array has a spare word at its end."""
    if not width:
        return np.zeros(len(start), dtype=np.uint64)
    start = start.astype(np.uint64)
    word, shift = (start // WORD).astype(np.int64), start % WORD
    low = words[word] >> shift
    # Shifted in two steps, as a shift by all 64 bits is not defined.
    high = (words[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
    return (low | high) & np.uint64((1 << width) - 1)


def encode(values: np.ndarray) -> bytes:
    """A sorted array of unsigned numbers: a header, the low bits packed, the high bits in unary."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    lows = np.zeros(n * width // 64 + 2, dtype=np.uint64)
    at = np.arange(n, dtype=np.uint64)
    if width and n:
        part, start = values & np.uint64((1 << width) - 1), at * np.uint64(width)
        word, shift = (start // WORD).astype(np.int64), start % WORD
        np.bitwise_or.at(lows, word, part << shift)
        np.bitwise_or.at(lows, word + 1, (part >> (np.uint64(63) - shift)) >> np.uint64(1))
    ones = (values >> np.uint64(width)) + at
    bits = np.zeros(((n + (top >> width) + 1) // 64 + 1) * 64, dtype=bool)
    bits[ones.astype(np.int64)] = True
    high = np.packbits(bits, bitorder="little")
    header = np.array([n, width, len(lows), len(high) // 8], dtype=np.uint64)
    return header.tobytes() + lows.tobytes() + high.tobytes()


class EliasFano:
    """A sequence that ``encode`` wrote, at some place of a buffer."""

    def __init__(self, buffer, offset: int = 0) -> None:
        n, width, n_low, n_high = (int(x) for x in np.frombuffer(buffer, np.uint64, 4, offset))
        self.n, self.width = n, width
        self.lows = np.frombuffer(buffer, np.uint64, n_low, offset + 32)
        self.high = np.frombuffer(buffer, np.uint64, n_high, offset + 32 + 8 * n_low)
        self.end = offset + 32 + 8 * (n_low + n_high)
        # How many ones, and zeros, there are before each word.
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    def _select(self, before: np.ndarray, words, k: np.ndarray) -> np.ndarray:
        """The position of one (or, in inverted words, zero) number ``k``."""
        word = np.searchsorted(before, k, side="right") - 1
        left = (k - before[word]).astype(np.int64)
        value, place = words(word), np.zeros(len(k), dtype=np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(value & np.uint64((1 << width) - 1)).astype(np.int64)
            later = left >= count
            left -= np.where(later, count, 0)
            place += np.where(later, width, 0)
            value = np.where(later, value >> np.uint64(width), value)
        return word * 64 + place

    def values(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        index = index.astype(np.int64)
        high = self._select(self.ones, lambda w: self.high[w], index) - index
        return (high.astype(np.uint64) << np.uint64(self.width)) | _at_bits(self.lows, index * self.width, self.width)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first number that is not smaller, ``n`` where there is none."""
        if not self.n:
            return np.zeros(len(x), dtype=np.int64)
        x = x.astype(np.uint64)
        inverted = lambda w: ~self.high[w]
        buckets = np.uint64(self.zeros[-1])
        bucket = x >> np.uint64(self.width)
        past = bucket >= buckets
        bucket = np.minimum(bucket, buckets - np.uint64(1)).astype(np.int64)
        # Numbers of a bucket stand between the zero before it and its own.
        first = np.zeros(len(x), dtype=np.int64)
        later = bucket > 0
        first[later] = self._select(self.zeros, inverted, bucket[later] - 1) - (bucket[later] - 1)
        last = self._select(self.zeros, inverted, bucket) - bucket
        part = x & np.uint64((1 << self.width) - 1)
        while True:
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                break
            middle = (first[open_] + last[open_]) // 2
            below = _at_bits(self.lows, middle * self.width, self.width) < part[open_]
            first[open_[below]] = middle[below] + 1
            last[open_[~below]] = middle[~below]
        return np.where(past, self.n, first)
