"""Shingle sets of documents and their minhashes, computed in arrays."""

from __future__ import annotations

import numpy as np

from lyceum.llm.words import WORD, Hashes, hashed, mixed, rolled


def shingle_sets(texts: list[bytes | None], width: int, table: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and each text's bounds.

    A to Z count as a to z.  A text of fewer than ``width`` words has its whole sequence as its only
    shingle; one without words has none."""
    lists = [WORD.findall(t.lower()) if t else [] for t in texts]  # bytes: lower() is ASCII only
    flat, bounds = hashed(lists, table)
    sizes = np.diff(bounds)
    whole = np.maximum(sizes - width + 1, 0)
    values = np.empty(int(whole.sum()) + int(((sizes > 0) & (sizes < width)).sum()), np.uint64)
    owner = np.empty(len(values), np.int64)
    own = rolled(flat, width, seed=width)
    doc = np.repeat(np.arange(len(sizes)), whole)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole) + bounds[doc]
    values[: len(doc)], owner[: len(doc)] = own[place], doc
    at = len(doc)
    for i in np.flatnonzero((sizes > 0) & (sizes < width)):
        values[at] = rolled(flat[bounds[i]:bounds[i + 1]], int(sizes[i]), seed=1000 + int(sizes[i]))[0]
        owner[at] = i
        at += 1
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(sizes) + 1))


def per_document(values: np.ndarray, bounds: np.ndarray, reduce: np.ufunc) -> np.ndarray:
    """A reduction over each text's values; texts without any must have been left out."""
    return reduce.reduceat(values, bounds[:-1]) if len(bounds) > 1 else np.empty(0, np.uint64)


def set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share: two sums of mixed members."""
    return tuple(per_document(mixed(values, seed), bounds, np.add) for seed in (11, 29))


def minhashes(values: np.ndarray, bounds: np.ndarray, n: int, seed: int = 20_240_517) -> np.ndarray:
    """``n`` minhashes of each text, as rows; members are hashes, so one multiplication reorders them."""
    draw = np.random.default_rng(seed)
    flips = draw.integers(0, 1 << 63, n, np.int64).astype(np.uint64)
    factors = draw.integers(0, 1 << 63, n, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    found = np.empty((len(bounds) - 1, n), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            found[:, k] = per_document((values ^ flips[k]) * factors[k], bounds, np.minimum)
    return found
