"""Alignment of two tokenizers by diagonal run skipping.

Both tokenizers cut the same bytes; a group ends where a token of each ends.  Most tokens come in one-to-one
stretches, in which the end arrays of both are equal at one shift between their indexes.  So from each group
on, blocks of doubling size are compared at the current shift until one differs, and the place is narrowed
down by halves; the irregular group there is resolved token by token, which sets the next shift.

The links of a document (pairs of tokens whose bytes overlap) are counted by id pair.  Documents travel
packed, some megabytes of text to a row, and ask for each id pair once a row, however many of them hold it;
counts come back the same way.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from lyceum.llm import sentencepiece_codec
from lyceum.llm.byte_bpe_codec import WHITE
from lyceum.llm.words import ragged, slices
from lyceum.session import scratch_path

# A byte-level tokenizer cuts before white space that follows something else, and no piece of a sentencepiece
# model that ``Codec`` takes crosses a space or a line feed.  So a chunk ends, for both, where one of these
# two follows something that is no white space.
OTHER = WHITE.replace("\t-\r ", "\t\v-\r")
CHUNK = re.compile(f"(?:[{WHITE}]+[^{WHITE}]*|[^{WHITE}]+)(?:[{OTHER}][{WHITE}]*[^{WHITE}]*)*")
LIMIT = 400_000  # chunks remembered
JOINED = 256  # chunks encoded at a time
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
SHIFT = 15  # bits of the second id in a pair
SLICE = 4 << 20  # bytes of text in a row

LOADED: dict[tuple[str, str], "Aligner"] = {}  # per worker process


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 signs stand for
    themselves, the others follow from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Bytes and byte lengths of ids."""

    def __init__(self, tokens: Sequence[bytes]):
        self.tokens = list(tokens)
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])


class ByteLevel(Vocabulary):
    """A byte-level BPE file of the tokenizers library; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        before = json.loads(self.library.to_str())
        if before["normalizer"] or before["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("not a plain byte-level tokenizer: chunks depend on each other")
        letters = byte_letters()
        names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        special = set(self.library.get_added_tokens_decoder())
        super().__init__([t.encode() if i in special else bytes(letters[c] for c in t) for i, t in enumerate(names)])

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after the other, and how many each has.  Chunks from white space to something
        else are encoded many at a time, since such joints are cut anyway."""
        proper = [c[0] in SPACES and c[-1] not in SPACES for c in chunks]
        jobs, at = [], 0
        while at < len(chunks):
            to = at + 1
            while to < len(chunks) and to - at < JOINED and proper[to] and proper[at]:
                to += 1
            jobs.append((at, to))
            at = to
        found = self.library.encode_batch(["".join(chunks[s:e]) for s, e in jobs], add_special_tokens=False)
        flat = np.array([i for e in found for i in e.ids], np.uint32)
        sizes = np.array([len(c.encode()) for c in chunks], np.int64)
        cuts = np.searchsorted(self.ends(flat), np.cumsum(sizes), side="right")
        return flat, np.diff(cuts, prepend=0)


class Pieces(Vocabulary):
    """A sentencepiece model, which puts a space before a text."""

    def __init__(self, path: str):
        self.codec = sentencepiece_codec.Codec(path)
        library = self.codec.library
        names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        super().__init__([bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace(sentencepiece_codec.MARK, " ").encode()
                          for i, n in enumerate(names)])

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.codec.segment(chunks)
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts


class PairedChunks:
    """Ids of the chunks seen lately in both vocabularies, and whether their bytes are those of the chunk."""

    def __init__(self, *sides: ByteLevel | Pieces):
        self.sides = sides
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = [np.empty(0, np.uint32) for _ in self.sides]
        self.starts = [np.zeros(1, np.int64) for _ in self.sides]
        self.exact = np.empty(0, bool)

    def learn(self, chunks: list[str]) -> None:
        first, exact = len(self.index), np.ones(len(chunks), bool)
        self.index.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        for k, side in enumerate(self.sides):
            flat, counts = side.segment(chunks)
            ends = np.cumsum(counts)
            tokens = list(map(side.tokens.__getitem__, flat.tolist()))
            exact &= [b"".join(tokens[e - n : e]) == c.encode()
                      for c, e, n in zip(chunks, ends.tolist(), counts.tolist(), strict=True)]
            self.ids[k] = np.concatenate([self.ids[k], flat])
            self.starts[k] = np.concatenate([self.starts[k], self.starts[k][-1] + ends])
        self.exact = np.concatenate([self.exact, exact])

    def __call__(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, given as its chunks, in both vocabularies; none where a chunk's bytes change."""
        distinct = set(chain.from_iterable(texts))
        if len(distinct) + len(self.index) > LIMIT:
            self.forget()
        new = sorted(distinct.difference(self.index))
        if new:
            self.learn(new)
        bounds = np.cumsum([0, *map(len, texts)])
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, int(bounds[-1]))
        wrong = np.concatenate([[0], np.cumsum(~self.exact[at])])
        right = wrong[bounds[1:]] == wrong[bounds[:-1]]
        both = []
        for ids, starts in zip(self.ids, self.starts, strict=True):
            counts = np.where(np.repeat(right, np.diff(bounds)), starts[at + 1] - starts[at], 0)
            ends = np.concatenate([[0], np.cumsum(counts)])[bounds[1:]]
            flat = ids[ragged(starts[at], counts)].astype(np.int64)
            both.append(np.split(flat, ends[:-1]) if len(texts) else [])
        return list(zip(*both, strict=True))


class Alignment(NamedTuple):
    """Groups: the index after the last token of each, in A and in B.  Links: token indexes, by place."""
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def ended(ends: np.ndarray, mark: int) -> bytes:
    """An end array as bytes, with a last entry that no entry of the other array equals."""
    return np.append(ends, 0xFFFF_FFFF - mark).astype("<u4").tobytes()


def equal_run(a: bytes, b: bytes, i: int, j: int) -> int:
    """How many entries are equal from i in a and j in b on: blocks that double until one differs, then halves."""
    i, j, size = 4 * i, 4 * j, 32
    while a[i : i + size] == b[j : j + size]:
        size += size
    same = size // 2 if size > 32 else 0
    while size - same > 4:
        half = (same + size) // 8 * 4
        if a[i + same : i + half] == b[j + same : j + half]:
            same = half
        else:
            size = half
    return same // 4


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Groups and links of two token sequences over the same bytes, given where their tokens end."""
    a, b = ended(ends_a, 0), ended(ends_b, 1)
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    n, i, j = len(list_a), 0, 0
    run_a, run_b, counts = [], [], []  # one-to-one stretches
    odd_a, odd_b, last_odd = [], [], []  # links of irregular groups; which of them end their group
    while i < n:
        end_a, end_b = list_a[i], list_b[j]
        if end_a == end_b:
            same = equal_run(a, b, i, j)
            run_a.append(i)
            run_b.append(j)
            counts.append(same)
            i, j = i + same, j + same
            continue
        while end_a != end_b:
            odd_a.append(i)
            odd_b.append(j)
            if end_a < end_b:
                i += 1
                end_a = list_a[i]
            else:
                j += 1
                end_b = list_b[j]
        last_odd.append(len(odd_a))
        odd_a.append(i)
        odd_b.append(j)
        i, j = i + 1, j + 1
    sizes, last = np.array(counts, np.int64), np.array(last_odd, np.int64)
    straight_a, straight_b = ragged(np.array(run_a, np.int64), sizes), ragged(np.array(run_b, np.int64), sizes)
    link_a, link_b = (np.concatenate([x, np.array(y, np.int64)]) for x, y in ((straight_a, odd_a), (straight_b, odd_b)))
    closing = np.concatenate([np.arange(len(straight_a)), last + len(straight_a)])
    groups = []
    for links, ends in ((link_a, ends_a), (link_b, ends_b)):
        closes = np.zeros(len(ends), bool)
        closes[links[closing]] = True
        groups.append(np.flatnonzero(closes) + 1)
    return Alignment(*groups, link_a, link_b)


class Aligned(NamedTuple):
    ids_a: np.ndarray
    ids_b: np.ndarray
    found: Alignment


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        if len(self.b.tokens) > 1 << SHIFT or len(self.a.tokens) > 1 << (32 - SHIFT):
            raise ValueError("ids do not fit a pair of 32 bits")
        self.chunks = PairedChunks(self.a, self.b)
        # Ids with what follows them in a listing, in fields of one width.
        self.named = np.concatenate([np.array([f"{i}{mark}" for i in range(len(side.tokens))], "S7")
                                     for side, marks in ((self.a, ",|"), (self.b, ",;")) for mark in marks])

    def __call__(self, texts: list[str | None]) -> list[Aligned]:
        """Ids and alignment of each text; a text whose bytes either tokenizer changes has no tokens."""
        chunks = [CHUNK.findall(" " + t) if t else [] for t in texts]
        return [Aligned(a, b, align(self.a.ends(a), self.b.ends(b))) for a, b in self.chunks(chunks)]

    def listed(self, one: Aligned) -> bytes:
        """Groups as text: ``a1,a2|b1;a3|b2,b3``."""
        n, m, (group_a, group_b, _, _) = len(one.ids_a), len(one.ids_b), one.found
        if not n:
            return b""
        out = np.empty(n + m, np.int64)
        # A token stands behind the tokens of its own side and those of the groups before, or up to its own.
        place_a = np.arange(n) + np.repeat(np.concatenate([[0], group_b[:-1]]), np.diff(group_a, prepend=0))
        place_b = np.arange(m) + np.repeat(group_a, np.diff(group_b, prepend=0))
        sizes = len(self.a.tokens), len(self.b.tokens)
        name_a, name_b = one.ids_a.copy(), one.ids_b + 2 * sizes[0]
        name_a[group_a - 1] += sizes[0]
        name_b[group_b - 1] += sizes[1]
        out[place_a], out[place_b] = name_a, name_b
        return self.named[out].tobytes().replace(b"\0", b"")[:-1]

    def pairs(self, one: Aligned) -> np.ndarray:
        """Id pairs of all links as numbers."""
        return (one.ids_a[one.found.link_a] << SHIFT) | one.ids_b[one.found.link_b]


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in LOADED:
        LOADED.clear()
        LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return LOADED[path_a, path_b]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of every whole text: (doc_id, groups array<struct<a: array<int>, b: array<int>>>), the ids of
    each in order.

    A (``path_a``, a byte-level file of the tokenizers library) reads a space and the text, B (``path_b``, a
    sentencepiece model) the text, before which it puts the space itself.  Null and empty texts, and those
    whose bytes a tokenizer changes, have no groups.  One row per input row, whatever the id, repeated ones
    too; an empty table gives no rows; extra columns are not read."""
    rows = keyed(docs, id_col, text_col)
    ids = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for part in slices(batches, "text"):
            groups = []
            for one in own(part.column("text").to_pylist()):
                cut_a, cut_b = (np.split(x, to[:-1]) if len(to) else [] for x, to in
                                ((one.ids_a, one.found.group_a), (one.ids_b, one.found.group_b)))
                groups.append([{"a": x.tolist(), "b": y.tolist()} for x, y in zip(cut_a, cut_b, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(groups, pa.list_(pa.struct([("a", ids), ("b", ids)])))], names=["doc_id", "groups"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, groups array<struct<a: array<int>, b: array<int>>>")


PACKED = ("slice bigint, doc_ids array<{kind}>, numbers array<bigint>, digests array<string>, sizes array<int>, "
          "links binary, asked array<bigint>, held array<int>")


def packed_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents with their links, some megabytes of text to a row.

    ``numbers`` has n_a, n_b, n_groups and n_links of each document; ``asked`` the id pairs of the row, in
    order, and ``held`` how many of its documents hold each; ``links`` the distinct pairs of each document,
    as places in ``asked``, and how often each occurs, ``sizes`` their numbers."""
    import zstandard

    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, squeeze = aligner(path_a, path_b), TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=1)
        for k, part in enumerate(slices(batches, "text", SLICE)):
            numbers, digests, pairs, times = [], [], [], []
            for one in own(part.column("text").to_pylist()):
                distinct, often = np.unique(own.pairs(one), return_counts=True)
                pairs.append(distinct)
                times.append(often)
                numbers += [len(one.ids_a), len(one.ids_b), len(one.found.group_a), len(one.found.link_a)]
                digests.append(hashlib.sha256(own.listed(one)).hexdigest() if len(one.ids_a) else "")
            asked, places, held = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            raw = np.concatenate([places.astype("<u4"), np.concatenate(times).astype("<u4")])
            blob = squeeze.compress(raw.view(np.uint8).reshape(-1, 4).T.tobytes())  # bytes by significance
            columns = [[(task << 32) + k], [part.column(0).to_pylist()], [numbers], [digests], [[len(p) for p in pairs]],
                       [blob], [asked], [held.astype(np.int32)]]
            types = [pa.int64(), pa.list_(part.column(0).type), pa.list_(pa.int64()), pa.list_(pa.string()),
                     pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names="slice doc_ids numbers digests sizes links asked held".split())

    return docs.mapInArrow(run, PACKED.format(kind=kind))


def pair_counts(packed: DataFrame) -> DataFrame:
    """(pair, value) of all id pairs: how many documents hold the pair, doubled, plus 1 if no other pair of
    its first id is held by more."""
    rows = packed.select(F.explode(F.arrays_zip("asked", "held")).alias("r")).select("r.*")
    totals = rows.groupBy(F.col("asked").alias("pair")).agg(F.sum("held").alias("total"))
    # An id has at most as many pairs as the other vocabulary has ids.
    most = F.max("total").over(W.partitionBy(F.shiftright("pair", SHIFT)))
    return totals.select("pair", (2 * F.col("total") + (F.col("total") == most).cast("long")).alias("value"))


def link_digests(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Alignment of every whole text and how usual its links are: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best (links of an id pair that as many documents hold as any pair of its A id), count_sum (over links:
    how many documents hold its id pair), groups_sha256 (of ``a1,a2|b1;a3|b2,b3``; without tokens empty).

    Cases as in ``alignments``; texts without tokens have zeros and an empty digest.  Every row counts as a
    document, repeated ids and repeated rows too.  The packed table goes to the shared folder."""
    path = scratch_path(spark, "links")
    rows = keyed(docs, id_col, text_col)
    packed_links(rows, path_a, path_b).write.option("compression", "zstd").parquet(path)
    packed = spark.read.schema(PACKED.format(kind=dict(rows.dtypes)["doc_id"])).parquet(path)

    asked = packed.select("slice", F.posexplode("asked").alias("place", "pair"))
    answers = asked.join(pair_counts(packed).hint("merge"), "pair").groupBy("slice").agg(
        F.collect_list(F.struct("place", "value")).alias("answers"))
    both = packed.drop("asked", "held").join(answers.hint("merge"), "slice", "left")
    return both.mapInArrow(summed, f"doc_id {dict(rows.dtypes)['doc_id']}, n_a long, n_b long, n_groups long, n_links long, "
                                   "n_best long, count_sum long, groups_sha256 string")


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of each document of a packed row."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(batch.num_rows):
            doc_ids, numbers, digests, sizes = (batch.column(c)[k].values for c in ("doc_ids", "numbers", "digests", "sizes"))
            sizes = sizes.to_numpy()
            raw = np.frombuffer(expand.decompress(batch.column("links")[k].as_py()), np.uint8)
            places, times = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64).reshape(2, -1)
            answers = batch.column("answers")[k].values
            value = np.zeros(0 if answers is None else len(answers), np.int64)
            if answers is not None:
                value[answers.field("place").to_numpy()] = answers.field("value").to_numpy()
            held, best = value[places] >> 1, value[places] & 1
            ends = np.cumsum(sizes)
            total, top = (np.diff(np.concatenate([[0], np.cumsum(x * times)])[np.concatenate([[0], ends])]) for x in (held, best))
            n_a, n_b, n_groups, n_links = numbers.to_numpy().reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (n_a, n_b, n_groups, n_links, top, total)), digests],
                names="doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split())
