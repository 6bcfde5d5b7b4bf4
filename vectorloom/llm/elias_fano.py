"""Elias-Fano sequences over plain buffers, so that a memory-mapped file can be one.

A sorted number is cut into ``low`` bits, stored side by side, and the rest, stored as
gaps of zeros between ones. All queries take arrays.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QBxxxxxxxQ")  # count, low bits, words of the upper part
U64 = np.uint64


def _mask(bits: int) -> np.uint64:
    return U64((1 << bits) - 1)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """Places of the ``k``-th (from 0) set or unset bits; ``before`` counts the set bits before each word."""
    if not len(k):
        return np.zeros(0, np.int64)
    if ones:
        word = np.searchsorted(before, k, side="right") - 1
        left = k - before[word]
        value = words[word]
    else:
        unset = np.arange(len(before), dtype=np.int64) * 64 - before
        word = np.searchsorted(unset, k, side="right") - 1
        left = k - unset[word]
        value = ~words[word]
    place = word.astype(np.int64) * 64
    for width in (32, 16, 8, 4, 2, 1):
        lower = value & _mask(width)
        count = np.bitwise_count(lower).astype(np.int64)
        up = left >= count
        left = np.where(up, left - count, left)
        value = np.where(up, value >> U64(width), lower)
        place = np.where(up, place + width, place)
    return place


class EliasFano:
    """A sorted sequence of numbers below 2**64, read from a buffer that ``pack`` made."""

    def __init__(self, buffer, at: int = 0):
        self.count, self.low, upper_words = HEAD.unpack_from(buffer, at)
        at += HEAD.size
        low_words = (self.count * self.low + 63) // 64 + 1
        self.lows = np.frombuffer(buffer, U64, low_words, at)
        at += 8 * low_words
        self.upper = np.frombuffer(buffer, U64, upper_words, at)
        at += 8 * upper_words
        self.before = np.frombuffer(buffer, np.int64, upper_words + 1, at)
        self.end = at + 8 * (upper_words + 1)

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = np.ascontiguousarray(values, U64)
        count = len(values)
        last = int(values[-1]) if count else 0
        low = max(0, (last // max(1, count)).bit_length() - 1)
        lows = np.zeros((count * low + 63) // 64 + 1, U64)
        if low and count:
            part = values & _mask(low)
            bit = np.arange(count, dtype=U64) * U64(low)
            word, shift = (bit >> U64(6)).astype(np.int64), bit & U64(63)
            np.bitwise_or.at(lows, word, part << shift)
            over = shift + U64(low) > 64
            np.bitwise_or.at(lows, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        ones = (values >> U64(low)).astype(np.int64) + np.arange(count) if count else np.zeros(0, np.int64)
        upper = np.zeros((last >> low) // 64 + count // 64 + 2, U64)
        np.bitwise_or.at(upper, ones >> 6, U64(1) << (ones & 63).astype(U64))
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])
        return HEAD.pack(count, low, len(upper)) + lows.tobytes() + upper.tobytes() + before.tobytes()

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), U64)
        bit = at.astype(U64) * U64(self.low)
        word, shift = (bit >> U64(6)).astype(np.int64), bit & U64(63)
        rest = np.where(shift > 0, self.lows[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return ((self.lows[word] >> shift) | rest) & _mask(self.low)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at places ``at``."""
        ones = _select(self.upper, self.before, at.astype(np.int64), True) - at
        return (ones.astype(U64) << U64(self.low)) | self._lows(at)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """For each number the place of the first one not below it; ``count`` if there is none."""
        wanted = wanted.astype(U64)
        high = wanted >> U64(self.low)
        # beyond the last upper value every number is smaller
        past = high >= U64(64 * len(self.upper) - self.count)
        high = np.where(past, U64(0), high).astype(np.int64)
        start = np.where(high > 0, _select(self.upper, self.before, np.maximum(high - 1, 0), False) - high + 1, 0)
        end = _select(self.upper, self.before, high, False) - high
        low = wanted & _mask(self.low)
        while True:  # binary search among those with the same upper part
            open_ = np.flatnonzero(start < end)
            if not len(open_):
                break
            middle = (start[open_] + end[open_]) // 2
            less = self._lows(middle) < low[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            end[open_] = np.where(less, end[open_], middle)
        return np.where(past, self.count, start)
