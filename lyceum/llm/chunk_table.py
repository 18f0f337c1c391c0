"""Distinct-chunk table: encode each distinct chunk of text once, join ids back by position."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

from lyceum.llm.words import ragged


class ChunkTable:
    """Ids of the chunks seen lately.  ``encode`` maps a list of chunks to lists of ids; it has to give a
    chunk the ids that it has inside a text.  At most ``limit`` chunks are kept between calls."""

    def __init__(self, encode: Callable[[list[str]], list[Sequence[int]]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, chunks: list[str]) -> None:
        lists = self.encode(chunks)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum()))
        first = len(self.index)
        self.index.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    def __call__(self, texts: Sequence[list[str]]) -> list[np.ndarray]:
        """Ids of each text, given as the list of its chunks."""
        distinct = set(chain.from_iterable(texts))
        if len(distinct) + len(self.index) > self.limit:
            self.forget()
        new = sorted(distinct.difference(self.index))
        if new:
            self.learn(new)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        starts, counts = self.starts[at], self.starts[at + 1] - self.starts[at]
        flat = self.ids[ragged(starts, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
        return np.split(flat, ends[:-1]) if len(texts) else []
