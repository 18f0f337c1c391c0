"""Words of texts: Spark expressions, and array forms for code that runs inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, functions as F

# What separates words.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")  # of UTF-8 bytes: separators are single bytes


def words_of(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one slice hold about ``size`` bytes (one row at least),
    which bounds what Python objects a task holds at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


class Hashes(dict):
    """Word to 64-bit hash, remembered for the words seen lately."""

    def __missing__(self, word: str | bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed(lists: Sequence[list], table: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some documents in one array, and each document's bounds in it."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=bounds[1:])
    flat = np.fromiter(map(table.__getitem__, chain.from_iterable(lists)), np.uint64, int(bounds[-1]))
    return flat, bounds


MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # of the first k bytes of a little-endian number
LONG = 128


def lowered_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, A-Z lower-cased, in one array, and each text's bounds in it.

    ``texts`` is an Arrow array of bytes, null: empty.  Words are hashed eight bytes at a time, all at once;
    those of more than ``LONG`` bytes one by one."""
    texts = pc.fill_null(texts, b"") if texts.null_count else texts
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(places, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]]
    offsets, n = offsets - offsets[0], len(raw)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lower = np.zeros(n + 8, np.uint8)  # eight spare bytes
    np.bitwise_or(raw, ((raw - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5), out=lower[:n])
    inside = (raw != 0x20) & ((raw - np.uint8(9)) >= 5)  # no separator
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    first, last = offsets[:-1][offsets[:-1] < n], offsets[1:][offsets[1:] > 0] - 1  # no word leaves its text
    begins[first], stops[last] = inside[first], inside[last]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(stops) + 1 - starts
    blocks = np.ndarray((n + 1,), "<u8", lower, strides=(1,))  # the eight bytes from each place on
    with np.errstate(over="ignore"):
        values = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = mixed(values ^ (blocks[starts] & MASKS[np.minimum(lengths, 8)]), 0)
    at = np.flatnonzero((lengths > 8) & (lengths <= LONG))
    done = 8
    while len(at):
        rest = lengths[at] - done
        values[at] = mixed(values[at] ^ (blocks[starts[at] + done] & MASKS[np.minimum(rest, 8)]), done)
        at, done = at[rest > 8], done + 8
    for k in np.flatnonzero(lengths > LONG):
        values[k] = xxhash.xxh3_64_intdigest(lower[starts[k]: starts[k] + lengths[k]].data)
    return values, np.searchsorted(starts, offsets)


def order_of(values: np.ndarray) -> np.ndarray:
    """An order that sorts 64-bit unsigned values.

    Their upper bits and places are sorted as one number, which is several times as fast as sorting places by
    values; where the bits left out tell values apart, the places are sorted."""
    n = len(values)
    if n < 2:
        return np.zeros(n, np.int64)
    spare = np.uint64(64 - max(int(values.max()).bit_length(), 1))
    mask = np.uint64((1 << (n - 1).bit_length()) - 1)
    both = values << spare  # then in place, as the values may be many
    both &= ~mask
    both |= np.arange(n, dtype=np.uint64)
    both.sort()
    both &= mask
    order = both.view(np.int64)
    ordered = values[order]
    return order if (ordered[1:] >= ordered[:-1]).all() else np.argsort(values)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct 64-bit unsigned value, in order, and for each value its number among them."""
    order = order_of(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64-bit values from 64-bit values (a finaliser of three rounds)."""
    with np.errstate(over="ignore"):
        x = values ^ np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolled(flat: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of ``width`` values from each start on; the last width - 1 starts have none."""
    n = len(flat) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = np.zeros(n, np.uint64)
    base = np.uint64((0x9E3779B97F4A7C15 + 2 * seed) | 1)
    own = mixed(flat, seed + 1)
    with np.errstate(over="ignore"):
        for k in range(width):
            value = value * base + own[k : k + n]
    return mixed(value, seed + 7)


def starts_inside(bounds: np.ndarray, width: int) -> np.ndarray:
    """Start positions, in the flat array, of windows that do not leave their document."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    return ragged(bounds[:-1], counts)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers starts[i] .. starts[i] + counts[i] - 1 for all i, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(np.asarray(starts, np.int64) - before, counts) + np.arange(total, dtype=np.int64)
