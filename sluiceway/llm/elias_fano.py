"""Monotone sequences in Elias-Fano form, over memory-mapped arrays.

Each number's low digits are packed side by side; its high digits are written in unary in a
bit array. Directories hold how many ones and zeros there are up to every SAMPLED words of
it; the rest is counted when asked. All operations work on arrays of queries.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Words of the high digits between two entries of a directory.
SAMPLED = 4


def _ones_below(k: np.ndarray | int) -> np.ndarray:
    """Masks of the k lowest bits, k up to 64."""
    k = np.asarray(k, _U)
    return np.where(k >= 64, ~_U(0), (_U(1) << (k & _U(63))) - _U(1))


_BYTES, _HIGH = _U(0x0101010101010101), _U(0x8080808080808080)
#: Position of the one bit of each rank in each byte value.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


def _select_in_word(x: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the one bit of that rank (from 0) in each word (Vigna, "Broadword implementation of rank/select queries")."""
    s = x - (x >> _U(1) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + (s >> _U(2) & _U(0x3333333333333333))
    s = (s + (s >> _U(4)) & _U(0x0F0F0F0F0F0F0F0F)) * _BYTES  # each byte: ones up to its end
    r = rank.astype(_U)
    at = np.bitwise_count((r * _BYTES | _HIGH) - s & _HIGH).astype(_U) << _U(3)
    rest = r - ((s << _U(8)) >> at & _U(0xFF))
    return at.astype(np.int64) + _IN_BYTE[(x >> at & _U(0xFF)).astype(np.int64), rest.astype(np.int64)]


def encode(values: np.ndarray, universe: int) -> list[np.ndarray]:
    """[header (count, low digits, universe), low digits, high digits, directories of ones and of zeros] of an ascending array of numbers below universe."""
    n = len(values)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    values = values.astype(_U)
    digits = np.empty((n, low_bits), np.uint8)
    for i in range(low_bits):  # a column at a time, so that no wider array is made
        digits[:, i] = values >> _U(i) & _U(1)
    high = np.zeros(n + (universe >> low_bits) + 1, np.uint8)
    high[(values >> _U(low_bits)).astype(np.int64) + np.arange(n)] = 1
    high = _words(high)
    ones = np.cumsum(np.bitwise_count(high).reshape(-1, SAMPLED).sum(1, dtype=np.int64))
    zeros = 64 * SAMPLED * np.arange(1, len(ones) + 1) - ones
    kind = np.uint32 if 64 * len(high) < 1 << 32 else np.uint64
    return [np.array([n, low_bits, universe], np.uint64), _words(digits.ravel()), high, ones.astype(kind), zeros.astype(kind)]


def _words(bits: np.ndarray) -> np.ndarray:
    """The bits as words, a multiple of SAMPLED, with one word beyond them at least."""
    data = np.packbits(bits, bitorder="little")
    return np.concatenate([data, np.zeros(-(len(data) + 8) % (8 * SAMPLED) + 8, np.uint8)]).view("<u8")


class EliasFano:
    def __init__(self, header: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> None:
        self.n, self.low_bits, self.universe = (int(x) for x in header)
        self.low, self.high, self.ones, self.zeros = low, high, ones, zeros

    def _select(self, rank: np.ndarray, zeros: bool) -> np.ndarray:
        """The position of the one (or zero) bit of that rank, from 0."""
        directory = self.zeros if zeros else self.ones
        at = np.searchsorted(directory, rank.astype(directory.dtype), "right")
        rest = rank - np.where(at > 0, directory[np.maximum(at, 1) - 1].astype(np.int64), 0)
        word = at * SAMPLED
        for _ in range(SAMPLED - 1):
            held = np.bitwise_count(self.high[word]).astype(np.int64)
            held = 64 - held if zeros else held
            on = rest >= held
            rest -= np.where(on, held, 0)
            word += on
        return 64 * word + _select_in_word(~self.high[word] if zeros else self.high[word], rest)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(_U)
        upper = np.where(shift > 0, self.low[word + 1] << (-shift & _U(63)), _U(0))
        return (self.low[word] >> shift | upper) & _ones_below(self.low_bits)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self._select(i, False) - i).astype(_U) << _U(self.low_bits) | self._low(i)

    def _bucket(self, high: np.ndarray) -> np.ndarray:
        """How many values have smaller high digits."""
        k = np.maximum(high - 1, 0)
        return np.where(high > 0, self._select(k, True) - k, 0)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each x below the universe, the index of the first value >= x, the end of the values with its high digits, and its low digits."""
        x = x.astype(_U)
        high, low = (x >> _U(self.low_bits)).astype(np.int64), x & _ones_below(self.low_bits)
        a, end = self._bucket(high), self._bucket(high + 1)
        b = end.copy()
        on = np.flatnonzero(a < b)
        while len(on):  # halves the ranges that are still open
            mid = (a[on] + b[on]) >> 1
            less = self._low(mid) < low[on]
            a[on[less]], b[on[~less]] = mid[less] + 1, mid[~less]
            on = on[a[on] < b[on]]
        return a, end, low

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The index of the first value >= x, for each x below the universe."""
        return self._search(x)[0]

    def find(self, x: np.ndarray) -> np.ndarray:
        """The index of the value x, for each x below the universe, or -1 where its successor is another."""
        at, end, low = self._search(x)
        there = np.flatnonzero(at < end)
        there = there[self._low(at[there]) == low[there]]
        out = np.full(len(x), -1)
        out[there] = at[there]
        return out
