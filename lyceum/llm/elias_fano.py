"""Elias-Fano sequences over numpy arrays: n non-decreasing numbers below u in about 2 + log2(u / n) bits each.

The upper bits of number i are a one at place (upper + i) of a bit string, the lower bits are packed.  All
queries are for arrays at a time, and every array may be memory-mapped."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


# Values that are packed at a time: their bits fill whole words.
AT_ONCE = 1 << 16


def packed(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bits of each value, one after the other, in 64-bit words (and a spare one)."""
    if not width or not len(values):
        return np.zeros(1, np.uint64)
    words = np.zeros(-(-len(values) * width // 64) + 1, np.uint64)
    places = np.arange(width, dtype=np.uint64)
    for at in range(0, len(values), AT_ONCE):
        part = values[at: at + AT_ONCE]
        own = words_from_bits(((part[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel())
        words[at * width // 64: at * width // 64 + len(own)] = own
    return words


def words_from_bits(bits: np.ndarray, spare: int = 0) -> np.ndarray:
    n = -(-len(bits) // 64) + spare
    raw = np.zeros(n * 8, np.uint8)
    short = np.packbits(bits, bitorder="little")
    raw[: len(short)] = short
    return raw.view("<u8")


def unpacked(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """Values of ``width`` bits at the given places."""
    if not width:
        return np.zeros(len(at), np.uint64)
    place = at.astype(np.uint64) * np.uint64(width)
    if width <= 57:  # within the eight bytes from the one on where the value begins
        from_byte = np.ndarray((len(words) * 8 - 7,), "<u8", words, strides=(1,))
        return (from_byte[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7))) & np.uint64((1 << width) - 1)
    word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1)


BYTES = np.uint64(0x0101010101010101)
# Place of the n-th one in each byte, for n from 0 on; what is not there is 0.
PLACES = np.array([([k for k in range(8) if byte >> k & 1] + [0] * 8)[:8] for byte in range(256)], np.uint8).ravel()


def nth_set(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th one (from 0 on) in each word, which must have so many: by ones up to each byte, then
    by a table."""
    words = np.ascontiguousarray(words, "<u8")
    ones = np.bitwise_count(words.view(np.uint8)).view("<u8") * BYTES  # byte k: ones in bytes 0 to k
    n = n.astype(np.uint64)
    # A byte of 128 + n - ones keeps its highest bit where ones <= n; no byte borrows from the next.
    low = (((n * BYTES) | (BYTES << np.uint64(7))) - ones) & (BYTES << np.uint64(7))
    shift = np.bitwise_count(low).astype(np.uint64) << np.uint64(3)
    n = n - (((ones << np.uint64(8)) >> shift) & np.uint64(255))
    byte = (words >> shift) & np.uint64(255)
    return (shift + PLACES[((byte << np.uint64(3)) | n).astype(np.int64)]).astype(np.int64)


def next_set(words: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first one behind the given place of each word, and which words have none."""
    rest = (words >> place.astype(np.uint64)) & ~np.uint64(1)
    lowest = np.bitwise_count((rest & -rest) - np.uint64(1))  # of no ones: 64
    return place + lowest, np.flatnonzero(rest == 0)


def successors(number: Callable[[np.ndarray], np.ndarray], begin: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each range of places with ordered numbers, the first place of the wanted one, if it is there; else
    any place of the range (of an empty one, its begin).  All ranges are halved at a time; those of one place
    are put aside when they are many."""
    found, size = begin.copy(), end - begin
    at = np.arange(len(found))
    begin = found.copy()
    while len(more := np.flatnonzero(size > 1)):
        if 2 * len(more) < len(size) or not size.all():
            found[at] = begin
            at, begin, size, wanted = at[more], begin[more], size[more], wanted[more]
        half = size >> 1
        begin += half * (number(begin + np.maximum(half - 1, 0)) < wanted)
        size -= half
    found[at] = begin
    return found


class EliasFano:
    """``arrays`` holds everything; ``n`` numbers with ``width`` lower bits; ones and zeros before each word."""

    def __init__(self, n: int, width: int, upper: np.ndarray, ones: np.ndarray, zeros: np.ndarray, lower: np.ndarray):
        self.n, self.width, self.upper, self.ones, self.zeros, self.lower = n, width, upper, ones, zeros, lower

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> "EliasFano":
        values, n = values.astype(np.uint64), len(values)
        width = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(n + (max(universe, 1) >> width) + 2, np.uint8)
        bits[high + np.arange(n)] = 1
        upper = words_from_bits(bits)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.uint32)]).astype(np.uint32)
        zeros = (np.arange(len(ones)) * 64 - ones).astype(np.uint32)
        return cls(n, width, upper, ones, zeros, packed(values, width))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        head = np.array([self.n, self.width], np.uint64)
        return {f"{name}.head": head, f"{name}.upper": self.upper, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros,
                f"{name}.lower": self.lower}

    @classmethod
    def loaded(cls, arrays: dict[str, np.ndarray], name: str) -> "EliasFano":
        n, width = (int(x) for x in arrays[f"{name}.head"])
        return cls(n, width, *(arrays[f"{name}.{part}"] for part in ("upper", "ones", "zeros", "lower")))

    def at(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        word = last_word(self.ones, i)
        return self.number(word * 64 + nth_set(self.upper[word], i - self.ones[word].astype(np.int64)), i)

    def number(self, place: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The numbers at places i, whose ones are at the given places of the upper bits."""
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | unpacked(self.lower, self.width, i)

    def at_both(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at places i and i + 1."""
        word = last_word(self.ones, i)
        bits = self.upper[word]
        inside = nth_set(bits, i - self.ones[word].astype(np.int64))
        later, more = next_set(bits, inside)
        later += word * 64
        if len(more):
            after = last_word(self.ones, i[more] + 1)
            later[more] = after * 64 + nth_set(self.upper[after], i[more] + 1 - self.ones[after].astype(np.int64))
        return self.number(word * 64 + inside, i), self.number(later, i + 1)

    def bounds(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many numbers have upper bits below ``high``, and how many not above."""
        k = np.maximum(high - 1, 0)
        word = last_word(self.zeros, k)
        bits = ~self.upper[word]
        inside = nth_set(bits, k - self.zeros[word].astype(np.int64))
        later, more = next_set(bits, inside)
        later += word * 64
        if len(more):
            after = last_word(self.zeros, k[more] + 1)
            later[more] = after * 64 + nth_set(~self.upper[after], k[more] + 1 - self.zeros[after].astype(np.int64))
        below = word * 64 + inside - k
        return np.where(high > 0, below, 0), np.where(high > 0, later - high, below)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number that is not smaller, if it is equal; else -1.

        The upper bits give a short run of numbers, which is searched by its lower bits."""
        high = (values >> np.uint64(self.width)).astype(np.int64)
        low = values & np.uint64((1 << self.width) - 1)
        inside = high <= int(len(self.upper) * 64 - self.n - 2)
        high = np.where(inside, high, 0)
        begin, end = self.bounds(high)
        place = successors(lambda at: unpacked(self.lower, self.width, at), begin, end, low)
        same = inside & (begin < end)
        same[same] = unpacked(self.lower, self.width, place[same]) == low[same]
        return np.where(same, place, -1)


def last_word(before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The last word with at most k before it.  Numbers of another type would have all of ``before`` copied."""
    return np.searchsorted(before, k.astype(before.dtype), side="right") - 1
