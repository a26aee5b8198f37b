"""Elias-Fano sequences: sorted numbers in about two bits each plus their low bits, searched without unpacking.

All methods work on whole numpy arrays of queries and read the parts of the
(possibly memory-mapped) sequence that the queries touch.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQ")  # numbers, low bits, words of the high part
_ONE = np.uint64(1)
_TWOS, _FOURS, _BYTES = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))
_EACH, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# The place of the k-th one of a byte, at 8 * byte + k.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for b in range(256) for k in range(8)], dtype=np.int64)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.ones = low, high, ones  # 64-bit words; ones before each word of the high part

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """``values``: unsigned 64-bit, not falling."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = _pack(values & np.uint64((1 << low_bits) - 1), low_bits)
        at = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(at[-1]) if n else 0) // 64 + 2, dtype=np.uint64)
        np.bitwise_or.at(high, (at >> np.uint64(6)).astype(np.int64), _ONE << (at & np.uint64(63)))
        count = np.bitwise_count(high).astype(np.uint64)
        return cls(n, low_bits, low, high, np.cumsum(count) - count)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.low_bits, len(self.high))
        return b"".join([head, *(x.astype("<u8").tobytes() for x in (self.low, self.high, self.ones))])

    @classmethod
    def read(cls, data: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at a byte of ``data`` (a multiple of 8), and the byte behind it."""
        n, low_bits, words = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        parts = []
        for size in (_low_words(n, low_bits), words, words):
            parts.append(np.frombuffer(data[at : at + 8 * size], dtype="<u8"))
            at += 8 * size
        return cls(n, low_bits, *parts), at

    def access(self, index: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        index = np.asarray(index, dtype=np.int64)
        high = (self._select(index, ones=True) - index).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(index)

    def access_two(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at some places and those behind them."""
        at = self._select(index, ones=True)
        after = self._next(at + 1, index + 1, ones=True)
        low = np.uint64(self.low_bits)
        return (at - index).astype(np.uint64) << low | self._low(index), (after - index - 1).astype(np.uint64) << low | self._low(index + 1)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The first place of each value, or -1.

        Numbers with the same high bits lie together; their places follow from two
        selections of zeros, and only their low bits are compared.
        """
        values = np.asarray(values, dtype=np.uint64)
        found = np.full(len(values), -1, dtype=np.int64)
        if not self.n or not len(values):
            return found
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        zeros = len(self.high) * 64 - self.n
        asked = np.flatnonzero((high >= 0) & (high < zeros))
        high, low = high[asked], values[asked] & np.uint64((1 << self.low_bits) - 1)
        first = np.zeros(len(asked), dtype=np.int64)
        later = high > 0
        first[later] = self._select(high[later] - 1, ones=False) + 1
        at = first - high
        limit = np.minimum(self._next(first, high, ones=False) - high, self.n)
        # Most buckets hold a number or two, which are looked at one by one; the low bits of a bucket rise.
        todo = np.flatnonzero(at < limit)
        for _ in range(2):
            here, seen, wanted = at[todo], self._low(at[todo]), low[todo]
            hit = np.flatnonzero(seen == wanted)
            found[asked[todo[hit]]] = here[hit]
            less = np.flatnonzero(seen < wanted)
            todo = todo[less]
            at[todo] = here[less] + 1
            todo = todo[at[todo] < limit[todo]]
        # A crowded one is searched by halves.
        begin, stop, wanted = at[todo], limit[todo], low[todo]
        active = np.arange(len(todo))
        while len(active):
            middle = (begin[active] + stop[active]) >> 1
            less = self._low(middle) < wanted[active]
            begin[active[less]] = middle[less] + 1
            stop[active[~less]] = middle[~less]
            active = active[begin[active] < stop[active]]
        inside = np.flatnonzero(begin < limit[todo])
        same = inside[self._low(begin[inside]) == wanted[inside]]
        found[asked[todo[same]]] = begin[same]
        return found

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.uint64)
        bit = index * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        first = self.low[word] >> shift
        second = (self.low[word + 1] << _ONE) << (np.uint64(63) - shift)
        return (first | second) & np.uint64((1 << self.low_bits) - 1)

    def _select(self, number: np.ndarray, ones: bool) -> np.ndarray:
        """Bit positions of the number-th ones or zeros (from 0) of the high part."""
        before = self.ones.view(np.int64)
        if ones:
            word = np.searchsorted(before, number, side="right") - 1
            left = (number - before[word]).astype(np.uint64)
        else:
            # Marks about as many as the numbers asked for, then halves: nothing as long as the sequence is made.
            apart = 1 << (len(before) // (4 * len(number) + 1)).bit_length()
            marks = np.arange(0, len(before), apart) * 64 - before[::apart]
            word = (np.searchsorted(marks, number, side="right") - 1) * apart
            step = apart >> 1
            while step:
                ahead = np.minimum(word + step, len(before) - 1)
                word = np.where(ahead * 64 - before[ahead] <= number, ahead, word)
                step >>= 1
            left = (number - (word * 64 - before[word])).astype(np.uint64)
        bits = self.high[word] if ones else ~self.high[word]
        # Ones up to each byte, all eight at once; then the byte is looked up.
        upto = bits - (bits >> _ONE & _TWOS)
        upto = (upto & _FOURS) + (upto >> np.uint64(2) & _FOURS)
        upto = (upto + (upto >> np.uint64(4)) & _BYTES) * _EACH
        byte = np.bitwise_count((left * _EACH | _TOPS) - upto & _TOPS).astype(np.uint64) << np.uint64(3)
        left -= upto << np.uint64(8) >> byte & np.uint64(255)
        inside = (bits >> byte & np.uint64(255)) << np.uint64(3) | left
        return word * 64 + byte.astype(np.int64) + _IN_BYTE[inside.astype(np.int64)]

    def _next(self, at: np.ndarray, number: np.ndarray, ones: bool) -> np.ndarray:
        """Bit positions of the first ones or zeros from ``at`` on, which are the number-th ones."""
        word = self.high[at >> 6]
        bits = (word if ones else ~word) >> (at & 63).astype(np.uint64)
        found = at + np.bitwise_count(~bits & (bits - _ONE))
        far = np.flatnonzero(bits == 0)
        if len(far):
            found[far] = self._select(number[far], ones)
        return found


def _low_words(n: int, low_bits: int) -> int:
    return n * low_bits // 64 + 2


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits, one behind the other, in 64-bit words."""
    words = np.zeros(_low_words(len(values), bits), dtype=np.uint64)
    if bits:
        at = np.arange(len(values), dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        np.bitwise_or.at(words, word + 1, (values >> _ONE) >> (np.uint64(63) - shift))
    return words
