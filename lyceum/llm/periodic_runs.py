"""Periodic runs of words: a suffix automaton whose links are a link-cut tree.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``least_exponent``
periods and ``least_length`` words long, that no neighbouring word extends.  The automaton of a stretch of
words has a state for each set of substrings that end at the same places; its links form a tree, in which
the path from the root to the state of a prefix holds all suffixes of that prefix.  Appending a word
recolours that path with its place (the access operation of a link-cut tree), and each segment met on the
way tells where its suffixes ended before.  If that was d words ago and the segment's longest suffix has
L >= d words, the last L + d words have smallest period d and nothing to the left extends them: a square.
Seen from place to place, the squares of one start and period grow into the run.

A word of a run occurs in it at least floor(least_exponent) times.  So a text is first cut at words that
occur less often in their stretch; what is cut off can neither be in a run nor extend one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.words import slices

WORD = re.compile("[^\x20\x09-\x0D]+")
PASSES = 8  # of cutting; more would only spare the automaton some words

Rewrite = Callable[[object, list[str]], list[str]]


class Automaton:
    """Suffix automaton of a sequence; state 1 is the empty word, 0 stands for none."""

    def __init__(self, words: list):
        self.length, self.link, self.follow, self.prefixes = [0, 0], [0, 0], [{}, {}], []
        last = 1
        for word in words:
            last = self.append(last, word)
            self.prefixes.append(last)

    def append(self, last: int, word: object) -> int:
        length, link, follow = self.length, self.link, self.follow
        new, at = len(length), last
        length.append(length[last] + 1)
        link.append(1)
        follow.append({})
        while at and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if not at:
            return new
        target = follow[at][word]
        if length[target] == length[at] + 1:
            link[new] = target
            return new
        copy = len(length)
        length.append(length[at] + 1)
        link.append(link[target])
        follow.append(follow[target].copy())
        link[new] = link[target] = copy
        while at and follow[at].get(word) == target:
            follow[at][word] = copy
            at = link[at]
        return new


class LastPlaces:
    """Link-cut tree over a tree given by ``parent``: its paths are splay trees, ordered by depth, and the
    root of each knows the place with which the path was coloured last (0: never)."""

    def __init__(self, parent: list[int]):
        self.up = list(parent)
        self.left, self.right, self.place = ([0] * len(parent) for _ in range(3))

    def rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        else:  # p was the root of its path
            self.place[x] = self.place[p]

    def splay(self, x: int) -> None:
        up, left, right, rotate = self.up, self.left, self.right, self.rotate
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g:
                if left[g] == p:
                    rotate(p if left[p] == x else x)
                elif right[g] == p:
                    rotate(p if right[p] == x else x)
            rotate(x)

    def recolour(self, node: int, place: int) -> list[tuple[int, int]]:
        """Colour the path from the root to ``node``; returns (deepest node, former place) of each segment."""
        up, right, places, met = self.up, self.right, self.place, []
        below = 0
        while node:
            if up[node]:
                self.splay(node)
            before = places[node]
            if before:
                met.append((node, before))
            cut = right[node]
            if cut:
                places[cut] = before
            right[node] = below
            below, node = node, up[node]
        places[below] = place
        return met


def squares(words: list) -> dict[tuple[int, int], int]:
    """(start, smallest period) to end of all maximal repetitions of at least two periods."""
    automaton = Automaton(words)
    tree, length = LastPlaces(automaton.link), automaton.length
    found: dict[tuple[int, int], int] = {}
    for place, node in enumerate(automaton.prefixes, 1):
        for deepest, before in tree.recolour(node, place):
            distance, reach = place - before, length[deepest]
            if distance <= reach:
                found[place - reach - distance, distance] = place
    return found


def stretches(words: list, least_length: int, least_count: int) -> list[tuple[int, int]]:
    """Parts of a sequence outside which no run is: each of their words occurs ``least_count`` times in them."""
    done, parts = [], [(0, len(words))]
    for _ in range(PASSES):
        left = []
        for start, end in parts:
            own = words[start:end]
            counts = Counter(own)
            if min(counts.values(), default=0) >= least_count:
                done.append((start, end))
                continue
            often = np.fromiter(map(counts.__getitem__, own), np.int64, len(own)) >= least_count
            edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]))).reshape(-1, 2) + start
            left += [(int(a), int(b)) for a, b in edges[edges[:, 1] - edges[:, 0] >= least_length]]
        parts = left
    return sorted(done + parts)


def runs_of(words: list, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, by start and period."""
    found = []
    for low, high in stretches(words, least_length, least_exponent):
        for (start, period), end in squares(words[low:high]).items():
            if end - start >= max(least_length, least_exponent * period):
                found.append((low + start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words less those that a run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = np.cumsum(edges)[:-1] > 0
    return [word for word, gone in zip(words, dropped.tolist(), strict=True) if not gone]


def as_they_are(_: object, words: list[str]) -> list[str]:
    return words


def periodic_runs(docs: DataFrame, least_length: int = 6, least_exponent: int = 4, rewrite: Rewrite = as_they_are,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of every whole text, and the text with each run cut to its first period: doc_id, n_words,
    runs array<struct<start, length, period>> by start and period, collapsed string (words kept, joined by
    one space).

    Words are numbered from 0; ``rewrite(id, words)`` may change a document's words first.  One row per input
    row, whatever the id, repeated ones too.  Null and empty texts have no words, no runs and an empty
    collapsed text; an empty table gives no rows; extra columns are not read.  Runs that overlap or share a
    start all count.  ``least_exponent`` is 2 at least.  Memory grows with the longest repetitive stretch of
    one text, at about 1 KB a word."""
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spans = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            counts, found, kept = [], [], []
            for key, text in zip(part.column(0).to_pylist(), part.column("text").to_pylist(), strict=True):
                words = rewrite(key, WORD.findall(text or ""))
                runs = runs_of(words, least_length, least_exponent)
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                kept.append(" ".join(collapsed(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(spans)), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                                "collapsed string")
