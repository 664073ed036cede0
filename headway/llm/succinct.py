"""Compact integer sequences: Elias-Fano coded monotone pointers and arrays of few bits.

Both are read from memory-mapped words, for many places at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

ONE = np.uint64(1)
#: Values packed at a time, so that temporary arrays stay small. A multiple of 64: no word is shared.
CHUNK = 1 << 17


def bit_width(largest: int) -> int:
    return max(1, int(largest).bit_length())


class BitArray:
    """Values of `width` bits each, one behind the other in 64-bit words."""

    def __init__(self, words: np.ndarray, width: int):
        self.words, self.width = words, width

    @staticmethod
    def pack(values: np.ndarray, width: int, zeros: Callable = np.zeros) -> np.ndarray:
        """Words of the values' last `width` bits; a spare word ends them, so that reading may always
        take two. zeros: makes the array that is filled, in memory by default."""
        mask = np.uint64((1 << width) - 1)
        words = zeros(len(values) * width // 64 + 2, np.uint64)
        for start in range(0, len(values), CHUNK):
            own = values[start : start + CHUNK].astype(np.uint64) & mask
            bits = np.arange(len(own), dtype=np.uint64) * np.uint64(width)
            word, shift = (bits >> np.uint64(6)).astype(np.int64) + start * width // 64, bits & np.uint64(63)
            np.bitwise_or.at(words, word, own << shift)
            over = shift + np.uint64(width) > 64
            np.bitwise_or.at(words, word[over] + 1, own[over] >> (np.uint64(64) - shift[over]))
        return words

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        bits = at.astype(np.uint64) * np.uint64(self.width)
        word, shift = (bits >> np.uint64(6)).astype(np.int64), bits & np.uint64(63)
        low = self.words[word] >> shift
        # A shift by 64 is undefined; so shift twice.
        high = (self.words[word + 1] << ONE) << (np.uint64(63) - shift)
        return (low | high) & np.uint64((1 << self.width) - 1)


class EliasFano:
    """A monotone sequence: low bits as they are, high bits in unary in a bit vector.

    before: the ones before each word of the bit vector, and all of them; made here where it is not given.
    """

    def __init__(self, high: np.ndarray, low: BitArray, low_bits: int, before: np.ndarray | None = None):
        self.high, self.low, self.low_bits = high, low, low_bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))]) if before is None else before

    @staticmethod
    def low_bits_for(n: int, largest: int) -> int:
        return max(0, (largest // max(1, n)).bit_length() - 1)

    @staticmethod
    def encode(values: np.ndarray, largest: int, zeros: Callable = np.zeros) -> tuple[np.ndarray, np.ndarray, int]:
        """High words, low words and number of low bits of ascending values up to largest."""
        n, bits = len(values), EliasFano.low_bits_for(len(values), largest)
        high = zeros((n + (largest >> bits)) // 64 + 2, np.uint64)
        for start in range(0, n, CHUNK):
            own = values[start : start + CHUNK].astype(np.uint64)
            at = (own >> np.uint64(bits)) + np.arange(start, start + len(own), dtype=np.uint64)
            np.bitwise_or.at(high, (at >> np.uint64(6)).astype(np.int64), ONE << (at & np.uint64(63)))
        return high, BitArray.pack(values, max(1, bits), zeros), bits

    def _place(self, i: np.ndarray) -> np.ndarray:
        """Where the i-th one of the bit vector stands."""
        word = np.searchsorted(self.before, i, "right") - 1
        bits, rank = self.high[word], (i - self.before[word]).astype(np.uint64)
        at = np.zeros(len(i), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((bits >> at) & np.uint64((1 << half) - 1)).astype(np.uint64)
            beyond = rank >= ones
            rank -= np.where(beyond, ones, 0).astype(np.uint64)
            at += np.where(beyond, half, 0).astype(np.uint64)
        return word * 64 + at.astype(np.int64)

    def _value(self, place: np.ndarray, i: np.ndarray) -> np.ndarray:
        value = (place - i) << self.low_bits
        return value | self.low[i].astype(np.int64) if self.low_bits else value

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return self._value(self._place(i), i)

    def pairs(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th values and those after them: the next one of the bit vector mostly stands in the same word."""
        place = self._place(i)
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        # A shift by 64 is undefined; so shift twice.
        above = (self.high[word] >> bit) >> ONE
        after = place + 1 + np.bitwise_count(~above & (above - ONE)).astype(np.int64)
        beyond = above == 0
        after[beyond] = self._place(i[beyond] + 1)
        return self._value(place, i), self._value(after, i + 1)


def find_in_ranges(ids: BitArray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """Index of `wanted` among ascending ids[low:high], or -1, for many ranges at once.

    Ids within a range are spread evenly, more or less, from 0 to largest: each round guesses the place
    from the bounds, and every third round halves the range instead, which bounds the rounds.
    """
    found = np.full(len(wanted), -1, np.int64)
    low, high = low.astype(np.int64), high.astype(np.int64) - 1
    floor, ceiling = np.zeros(len(wanted), np.float64), largest.astype(np.float64)
    active = np.flatnonzero(low <= high)
    rounds = 0
    while len(active):
        a, b = low[active], high[active]
        goal = wanted[active].astype(np.float64)
        if rounds % 3 == 2:
            guess = (a + b) >> 1
        else:
            share = (goal - floor[active]) / np.maximum(ceiling[active] - floor[active], 1)
            guess = np.clip(a + (share * (b - a)).astype(np.int64), a, b)
        value = ids[guess].astype(np.int64)
        goal_int = wanted[active]
        hit = value == goal_int
        found[active[hit]] = guess[hit]
        above = value < goal_int
        low[active[above]] = guess[above] + 1
        floor[active[above]] = value[above]
        below = value > goal_int
        high[active[below]] = guess[below] - 1
        ceiling[active[below]] = value[below]
        active = active[~hit & (low[active] <= high[active])]
        rounds += 1
    return found
