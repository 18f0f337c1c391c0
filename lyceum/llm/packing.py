"""Best-fit packing of token lists into sequences, after Martello-Toth dominance reduction.

Pieces of the same length are interchangeable, so the packing problem is a histogram of lengths: as many
numbers as a sequence has tokens, whatever the number of documents.  The histogram is reduced (small
sets that provably dominate all others with the same longest piece are fixed), the rest is packed best
fit, and the outcome is a list of patterns with counts, again bounded by the sequence length.  Pieces are
ranked within their length by a distributed count and find their place in the patterns by their rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lyceum.llm.chunk_table import ChunkTable
from lyceum.llm.words import slices
from lyceum.session import scratch_path

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r".,!?#$%&*"
# A word without its final punctuation, that punctuation, or whatever else stands between white space.
CHUNK = re.compile(
    rf"(?<![^\x20\x09-\x0D])[{LETTERS}]+(?=[{MARKS}]*(?![^\x20\x09-\x0D]))"
    rf"|(?<=[{LETTERS}])[{MARKS}]+(?![^\x20\x09-\x0D])"
    r"|[^\x20\x09-\x0D]+")

WORD = re.compile(f"[{LETTERS}]+")
JOINED = 500  # words that are encoded as one text

LOADED: dict[str, ChunkTable] = {}  # per worker process


def chunk_encoder(tokenizer):
    """Ids of many chunks.  Words of letters are encoded joined by spaces and cut behind the tokens that end
    a word; other chunks, and a text whose word ends do not add up, are encoded one by one."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    vocab = tokenizer.get_vocab()
    closes = np.zeros(max(vocab.values(), default=0) + 1, bool)
    closes[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    def ids(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(chunks: list[str]) -> list[Sequence[int]]:
        found: list[Sequence[int] | None] = [None] * len(chunks)
        words = [i for i, chunk in enumerate(chunks) if suffix and WORD.fullmatch(chunk)]
        groups = [words[k:k + JOINED] for k in range(0, len(words), JOINED)]
        for group, joined in zip(groups, ids([" ".join(chunks[i] for i in g) for g in groups]), strict=True):
            row = np.array(joined, np.int64)
            ends = np.flatnonzero(closes[row]) + 1
            if len(ends) == len(group) and ends[-1] == len(row):
                for i, start, end in zip(group, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    found[i] = joined[start:end]
        rest = [i for i, own in enumerate(found) if own is None]
        for i, own in zip(rest, ids([chunks[i] for i in rest]), strict=True):
            found[i] = own
        return found

    return encode


def tokenizer_table(path: str) -> ChunkTable:
    """Ids of chunks by a word-level BPE that drops white space and never joins a letter with punctuation."""
    if path not in LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        probe = "Ab, cd.  ef!?\n\tg'h <|endoftext|>x ﬁn. 12,3"
        apart = [i for c in CHUNK.findall(probe) for i in tokenizer.encode(c, add_special_tokens=False).ids]
        if apart != tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError("this tokenizer gives a word other ids inside a text")
        LOADED.clear()
        LOADED[path] = ChunkTable(chunk_encoder(tokenizer))
    return LOADED[path]


PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text plus ``end_id``, cut into pieces of at most ``size``; ids stay where the
    text is, only their places and checksums go on.  A null text is empty: one piece, the end id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = tokenizer_table(tokenizer), np.array([end_id], np.uint32)
        for part in slices(batches, "text"):
            lists = table([CHUNK.findall(t) if t else [] for t in part.column("text").to_pylist()])
            owner, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(lists):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, at in enumerate(range(0, len(ids), size)):
                    cut = ids[at:at + size]
                    owner.append(i), piece.append(k), start.append(at), length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, PIECES.format(id=dict(rows.dtypes)["doc_id"]))


@dataclass
class Plan:
    """Patterns of piece lengths: ``times`` sequences each hold ``parts``, (length, how many) in order."""

    times: list[int] = field(default_factory=list)
    parts: list[tuple[tuple[int, int], ...]] = field(default_factory=list)

    def add(self, times: int, parts: tuple[tuple[int, int], ...]) -> None:
        if times:
            self.times.append(times)
            self.parts.append(parts)


class Lengths:
    """A histogram of lengths with the lengths at hand in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.count)

    def largest_fitting(self, room: int) -> int | None:
        at = bisect_right(self.sizes, room)
        return self.sizes[at - 1] if at else None

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect_right(self.sizes, size) - 1)


def sum_of_smallest(left: Lengths, own: int, n: int, above: int = 0) -> int:
    """Sum of the n smallest pieces longer than ``above``, besides one of length ``own``."""
    found: list[int] = []
    for size in left.sizes[bisect_right(left.sizes, above):]:
        found += [size] * min(n, left.count[size] - (size == own))
        if len(found) >= n:
            return sum(found[:n])
    return 1 << 60


def best_pair(left: Lengths, own: int, room: int) -> tuple[int, int] | None:
    """Two pieces besides one of length ``own`` with the largest sum that fits."""
    sizes, low, high = left.sizes, 0, bisect_right(left.sizes, room) - 1
    best, total = None, -1
    free = lambda s: left.count[s] - (s == own)
    while low <= high:
        a, b = sizes[low], sizes[high]
        if a + b > room or not free(b):
            high -= 1
            continue
        if a + b > total and free(a) >= 1 and (a != b or free(a) >= 2):
            best, total = (b, a), a + b
        low += 1
    return best


def reduce_by_dominance(left: Lengths, capacity: int, plan: Plan) -> None:
    """Fix sets of up to three pieces that dominate every other set with the same longest piece.

    Longest first: alone, if nothing fits beside it; with the largest fitting piece, if that fills the
    sequence, if no two others fit, or if no three others fit and it is as long as the best fitting pair;
    with the best pair, if its longer piece is the largest fitting one, no three others fit, and no two that
    are both longer than its shorter one.  Sets are fixed for as many pieces as have them at once.  What
    passes none of the tests is left alone."""
    again = True
    while again:
        again = False
        for own in sorted(left.count, reverse=True):
            while left.count.get(own):
                room = capacity - own
                left.take(own, 1)  # what may stand beside one piece of this length
                mate = left.largest_fitting(room)
                left.count[own] = left.count.get(own, 0) + 1
                if left.count[own] == 1:
                    left.sizes.insert(bisect_right(left.sizes, own), own)
                if mate is None:
                    n = left.count[own]
                    left.take(own, n)
                    plan.add(n, ((own, 1),))
                    again = True
                    continue
                pair = best_pair(left, own, room) if sum_of_smallest(left, own, 2) <= room else None
                three = sum_of_smallest(left, own, 3) <= room
                if mate == room or pair is None or (not three and mate >= sum(pair)):
                    if mate == own:
                        n = left.count[own] // 2
                        left.take(own, 2 * n)
                        plan.add(n, ((own, 2),))
                    else:
                        n = min(left.count[own], left.count[mate])
                        left.take(own, n)
                        left.take(mate, n)
                        plan.add(n, ((own, 1), (mate, 1)))
                    again = True
                    continue
                if pair[0] == mate and not three and sum_of_smallest(left, own, 2, above=pair[1]) > room:
                    need: dict[int, int] = {}
                    for s in (own, *pair):
                        need[s] = need.get(s, 0) + 1
                    n = min(left.count[s] // k for s, k in need.items())
                    for s, k in need.items():
                        left.take(s, n * k)
                    plan.add(n, tuple(need.items()))
                    again = True
                    continue
                break


def best_fit(left: Lengths, capacity: int, plan: Plan) -> None:
    """Longest first, each piece into the fullest sequence that has room; equal sequences go together."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []  # sorted rooms in use

    def put(room: int, times: int, parts: tuple) -> None:
        if not times:
            return
        if room not in open_by_room:
            open_by_room[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_by_room[room].append([times, parts])

    for size in sorted(left.count, reverse=True):
        n = left.count[size]
        while n:
            at = bisect_right(rooms, size - 1)
            if at < len(rooms):
                room = rooms[at]
                times, parts = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                room, parts = capacity, ()
                times = -(-n // (capacity // size))
            each = room // size
            full = min(times, n // each)
            put(room - each * size, full, (*parts, (size, each)))
            n -= full * each
            rest = times - full
            if rest and n:
                put(room - n * size, 1, (*parts, (size, n)))
                n, rest = 0, rest - 1
            if parts:
                put(room, rest, parts)
    for groups in open_by_room.values():
        for times, parts in groups:
            plan.add(times, parts)


def pack_histogram(counts: dict[int, int], capacity: int) -> Plan:
    plan, left = Plan(), Lengths(counts)
    reduce_by_dominance(left, capacity, plan)
    best_fit(left, capacity, plan)
    return plan


def places(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, the ranks at which an entry of the plan begins, and the entry: first sequence,
    pieces of this length per sequence, offset of the first."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for times, parts in zip(plan.times, plan.parts, strict=True):
        offset = 0
        for size, each in parts:
            rank = used.get(size, 0)
            found.setdefault(size, []).append((rank, first, each, offset))
            used[size] = rank + times * each
            offset += size * each
        first += times
    return {s: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for s, rows in found.items()}


def ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """``pieces`` with ``rank``: a number from 0 on within each length.  A length is numbered in
    ``groups`` groups of its own, so one that a third of all pieces have is no single group."""
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = grouped.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = sizes.select("length", "group", (F.sum("n").over(
        Window.partitionBy("length").orderBy("group")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return (grouped.withColumn("own", own).join(before, ["length", "group"])
            .withColumn("rank", F.col("before") + F.col("own")).drop("group", "own", "before"))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", groups: int | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Only documents
    longer than ``size`` are cut.  Null and empty texts are one piece with the end id; null ids and
    repeated rows are packed like any other row (pieces alike in all columns may swap places); an empty
    table gives no rows; extra columns are not read.  Ranks are counted in ``groups`` groups a length (by
    default the number of shuffle partitions).  Pieces are written to the shared folder once, so
    that the histogram and the placing see the same rows even if tasks are run again."""
    written = scratch_path(spark, "pieces")
    tokenize_pieces(docs, tokenizer, size, end_id, id_col, text_col).write.parquet(written)
    pieces = spark.read.parquet(written)
    # At most ``size`` rows come to the driver.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(pack_histogram(counts, size))
    rows = ranked(pieces, groups or int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                begins, first, each, base = table[int(one)]
                entry = np.searchsorted(begins, rank[at], side="right") - 1
                inside = rank[at] - begins[entry]
                sequence[at] = first[entry] + inside // each[entry]
                offset[at] = base[entry] + inside % each[entry] * one
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        run, PIECES.format(id=kind) + ", sequence_id long, offset long")
