"""Elias-Fano coding of monotone integer lists with select and successor.

A list of n values, less the first one all below u, keeps the low bits of each
value, l = floor(log2(u / n)) of them, in a packed array and the high parts in unary: bit (v >> l) + i
is set for the i-th value. That is about 2 + l bits for a value. ``select``
goes through the number of set bits before each 64-bit word.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQQQ")
_ONES, _TOPS, _FIVES, _THREES, _FIFTEENS = (np.uint64(b * 0x0101010101010101) for b in (0x01, 0x80, 0x55, 0x33, 0x0F))
#: Place of the k-th set bit of a byte, at 256 k + byte.
_BIT_OF = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8) for b in range(256)], "i8")


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits each, one after the other, little end first."""
    if not width or not len(values):
        return b""
    n, size = len(values), (len(values) * width + 7) // 8
    bit = np.arange(n, dtype="i8") * width
    shift = (bit & 63).astype("u8")
    # a value is shorter than a word of 64 bits, so one begins in every word
    first = (np.arange((int(bit[-1]) >> 6) + 1, dtype="i8") * 64 + width - 1) // width
    out = np.zeros(len(first) + 1, "<u8")
    out[:-1] = np.bitwise_or.reduceat(values << shift, first)
    over = np.flatnonzero(shift + np.uint64(width) > 64)
    out[(bit[over] >> 6) + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out.tobytes()[:size].ljust(size + 8 + -size % 8, b"\0")


def _read_bits(packed: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The values of ``width`` <= 56 bits at the given places."""
    if not width:
        return np.zeros(len(at), "u8")
    bit = at.astype("i8") * width
    eights = np.ndarray((len(packed) - 7,), "<u8", packed, strides=(1,))
    return (eights[bit >> 3] >> (bit & 7).astype("u8")) & np.uint64((1 << width) - 1)


class EliasFano:
    """A monotone list; ``data`` is its coded form and may be memory-mapped."""

    def __init__(self, data):
        buf = np.frombuffer(data, "u1") if not isinstance(data, np.ndarray) else data
        self.n, self.u, self.low_bits, words, base = _HEAD.unpack(bytes(buf[:_HEAD.size]))
        self.base = np.uint64(base)
        at, packed = _HEAD.size, (self.n * self.low_bits + 7) // 8
        low = packed + 8 + -packed % 8 if packed else 0
        self.low = buf[at:at + low]
        at += low
        self.high = buf[at:at + 8 * words].view("<u8")
        at += 8 * words
        self.size = at
        self.before = np.zeros(words + 1, "i8")
        np.cumsum(np.bitwise_count(self.high), out=self.before[1:])
        self.zeros = np.arange(words + 1, dtype="i8") * 64 - self.before

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        """Values are >= 0 and never fall."""
        v = np.ascontiguousarray(values, "u8")
        n, base = len(v), int(v[0]) if len(v) else 0
        v = v - np.uint64(base)
        u = int(v[-1]) + 1 if n else 1
        low = min(56, max(0, (u // n).bit_length() - 1)) if n else 0
        lows = _pack_bits(v & np.uint64((1 << low) - 1), low)
        place = (v >> np.uint64(low)).astype("i8") + np.arange(n)
        words = (int(place[-1]) >> 6) + 1 if n else 0
        high = np.zeros(words * 64, "u1")
        high[place] = 1
        return _HEAD.pack(n, u, low, words, base) + lows + np.packbits(high, bitorder="little").tobytes()

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        i = np.asarray(i, "i8")
        return ((self._select_bit(i) - i).astype("u8") << np.uint64(self.low_bits) | _read_bits(self.low, i, self.low_bits)) + self.base

    def _in_word(self, word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit (from 0) of each 64-bit word: its byte by the bits up to each byte's end, then its bit by a table."""
        k = k.astype("u8")
        upto = word - ((word >> np.uint64(1)) & _FIVES)
        upto = (upto & _THREES) + ((upto >> np.uint64(2)) & _THREES)
        upto = ((upto + (upto >> np.uint64(4))) & _FIFTEENS) * _ONES
        # a byte's top bit stays set where no more than k bits are set up to its end
        at = np.bitwise_count((k * _ONES | _TOPS) - upto & _TOPS).astype("u8") << np.uint64(3)
        k -= (upto << np.uint64(8)) >> at & np.uint64(255)
        return at.astype("i8") + _BIT_OF.take((k << np.uint64(8) | (word >> at) & np.uint64(255)).astype("i8"), mode="clip")

    def _select_bit(self, i: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.before, i, side="right") - 1
        return (w << 6) + self._in_word(self.high[w], i - self.before[w])

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each value in the list, -1 where it is not (successor search: the first value not below ``x``)."""
        x = np.asarray(x, "u8")
        if not self.n or not len(x):
            return np.full(len(x), -1, "i8")
        at, below = np.full(len(x), -1, "i8"), x < self.base
        x = x - self.base
        todo = np.flatnonzero(~below & (x < np.uint64(self.u)))
        high = (x[todo] >> np.uint64(self.low_bits)).astype("i8")
        low = x[todo] & np.uint64((1 << self.low_bits) - 1)
        # values with this high part stand between the zero bits before and at it; halve that range by the low bits
        first = np.flatnonzero(np.diff(high, prepend=-1))  # queries in order: once for a run with the same high part
        runs, some = np.diff(first, append=len(high)), high[first]
        i = np.repeat(self._select_zero(some - 1) + 1 - some, runs)
        end = np.repeat(self._select_zero(some) - some, runs)
        while True:
            on = i < end
            if not on.all():
                todo, low, i, end = todo[on], low[on], i[on], end[on]
            if not len(todo):
                return at
            mid = (i + end) >> 1
            have = _read_bits(self.low, mid, self.low_bits)
            same = have == low
            at[todo[same]] = mid[same]
            less = have < low
            i, end = np.where(less, mid + 1, i), np.where(less | same, end, mid)
            i = np.where(same, end, i)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th zero bits; -1 for k = -1."""
        zeros = self.zeros
        out = np.full(len(k), -1, "i8")
        some = np.flatnonzero(k >= 0)
        k = k[some]
        w = np.searchsorted(zeros, k, side="right") - 1
        past = w >= len(self.high)  # beyond the last word all bits are zero
        w = np.minimum(w, len(self.high) - 1)
        place = (w << 6) + self._in_word(~self.high[w], np.minimum(k - zeros[w], 63))
        out[some] = np.where(past, len(self.high) * 64 + k - zeros[-1], place)
        return out

    def all(self) -> np.ndarray:
        """All values, decoded together."""
        if not self.n:
            return np.zeros(0, "u8")
        ones = np.flatnonzero(np.unpackbits(self.high.view("u1"), bitorder="little"))[:self.n]
        i = np.arange(self.n)
        return ((ones - i).astype("u8") << np.uint64(self.low_bits) | _read_bits(self.low, i, self.low_bits)) + self.base
