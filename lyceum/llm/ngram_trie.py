"""Language-model scores from an n-gram trie of Elias-Fano levels.

Level 1 holds every training token, sorted by hash, with its exact count; a token's place is its id.  Level k
holds the n-grams of k tokens counted ``min_count`` times or more (1: all of them), as (context, token): the
context is the id of an n-gram of level k - 1.  A level is cut into shards by a hash of (context, token), so no context, however frequent,
is in one shard.  In a shard, contexts and the pointers to their followers are monotone sequences in
Elias-Fano form; followers are sorted within their context and found there by successor search; smoothed
probabilities are quantised.  Shards are files of the shared folder that tasks map into memory; pages that
are not asked for are not read, and no level is sent to a task or to the driver.

Probabilities are interpolated with absolute discounting:
    p(w | context) = (c - D) / c(context) + left(context) p(w | shorter context)    for kept n-grams,
    p(w | context) = left(context) p(w | shorter context)                          for all others,
with left(context) what the discounts and the n-grams not kept leave, and p(w) = (c + 1) / (N + V + 1), so
that the probabilities of all tokens, and one for all unknown ones, sum to 1 (but for quantisation).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from lyceum.llm.elias_fano import EliasFano, successors
from lyceum.llm.mapped import Store
from lyceum.llm.words import distinct, lowered_hashes, mixed, order_of, slices
from lyceum.session import scratch_path

END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no token holds a line feed
STEP = 1 / 2048  # of quantised log10 values, 0 to -32
SLICE = 4 << 20
AT_ONCE = 1 << 20  # followers whose probabilities are worked out at a time
PER_SHARD = 8_000_000  # training tokens for each shard of a level above the first, at most
SENT = "shard int, keys binary, counts binary"


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-logs / STEP), 0, 65_535).astype(np.uint16)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def grouped(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each shard's values, in order."""
    shard = shard.astype(np.min_scalar_type(shards))  # 16 bits are sorted by counting
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    for own in np.flatnonzero(np.diff(ends, prepend=0)):
        yield int(own), order[ends[own - 1] if own else 0: ends[own]]


def packed(values: np.ndarray) -> bytes:
    """Values of eight bytes, laid out by significance: most of those bytes are alike and compress to little."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    laid = np.empty((8, len(raw)), np.uint8)
    for k in range(8):
        laid[k] = raw[:, k]
    return zstandard.ZstdCompressor(level=1).compress(laid.data)


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    laid = raw.reshape(8, -1)
    values = np.empty((laid.shape[1], 8), np.uint8)
    for k in range(8):
        values[:, k] = laid[k]
    return values.view(kind).ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = order_of(keys)
    keys = keys[order]
    counts = counts[order]
    del order
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    if new.all():
        return keys, counts
    return keys[new], np.add.reduceat(counts, np.flatnonzero(new))


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """All parts in one array; each is let go as soon as it is copied."""
    if len(parts) == 1:
        return parts.pop()
    both = np.empty(sum(map(len, parts)), parts[0].dtype)
    end = len(both)
    while parts:
        begin = end - len(parts[-1])
        both[begin:end] = parts.pop()
        end = begin
    return both


def summed_parts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``summed`` over parts, which are taken out of their lists."""
    own = joined(keys)
    return summed(own, joined(counts))


class Tally:
    """Counts of keys in a task; sent on by shard when there are many."""

    LIMIT = 3_000_000

    def __init__(self, shards: int, place: Callable[[np.ndarray], np.ndarray]):
        self.shards, self.place = shards, place
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts.astype(np.uint64)))
        self.size += len(keys)
        if self.size > self.LIMIT:
            self.merge()
            if self.size > self.LIMIT // 2:
                yield from self.rows()

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts = (list(x) for x in zip(*self.parts, strict=True))
            self.parts = []
            self.parts = [summed_parts(keys, counts)]
            self.size = len(self.parts[0][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.size:
            yield from sent(*self.parts[0], self.place(self.parts[0][0]), self.shards)
        self.parts, self.size = [], 0


def sent(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Keys in order and their counts, a row for each shard; of the keys the steps between them are sent."""
    for own, at in grouped(shard, shards):
        yield pa.RecordBatch.from_arrays(
            [pa.array([own], pa.int32()), pa.array([packed(np.diff(keys[at], prepend=np.uint64(0)))], pa.binary()),
             pa.array([packed(counts[at])], pa.binary())], names=["shard", "keys", "counts"])


def by_shard(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each shard of a task with its keys and sums.  Rows wait as they came, and are unpacked shard by shard."""
    rows: dict[int, list[tuple[pa.Scalar, pa.Scalar]]] = {}
    for batch in batches:
        for shard, keys, counts in zip(*(batch.column(c) for c in ("shard", "keys", "counts")), strict=True):
            rows.setdefault(shard.as_py(), []).append((keys, counts))
    for shard in sorted(rows):
        own, keys, counts = rows.pop(shard), [], []
        while own:
            blobs = [x.as_buffer() for x in own.pop()]
            keys.append(np.cumsum(unpacked(blobs[0], "<u8"), dtype=np.uint64))
            counts.append(unpacked(blobs[1], kind))
        yield shard, *summed_parts(keys, counts)


@dataclass
class Shape:
    """What all tasks know of a model: where it is, and how many entries its shards have."""

    uri: str
    shards: int              # of the first level, and of those above it at least
    discount: float
    bases: list[np.ndarray]  # per level, the first id of each shard, and the end
    tokens: int = 0          # N
    bits: int = 0            # for the ids of tokens, in keys (context, token)
    min_count: int = 1       # of the n-grams kept in levels above the first

    @property
    def distinct(self) -> int:
        return int(self.bases[0][-1])

    def shards_of(self, level: int) -> int:
        """A level has no more n-grams than there are tokens, so a task's share does not grow with the texts."""
        return self.shards if level == 1 else max(self.shards, -(-self.tokens // PER_SHARD))


class Trie:
    """Lookups in the levels of a model, for arrays of tokens."""

    def __init__(self, shape: Shape):
        self.shape, self.store = shape, Store(shape.uri)
        self.files: dict[str, dict[str, np.ndarray]] = {}
        self.sequences: dict[tuple[int, int], tuple[EliasFano, EliasFano]] = {}

    def file(self, name: str) -> dict[str, np.ndarray]:
        if name not in self.files:
            self.files[name] = self.store.read(name)
        return self.files[name]

    def tokens(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of each token."""
        ids, counts = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for shard, at in grouped(shard_of(hashes, self.shape.shards), self.shape.shards):
            if self.shape.bases[0][shard + 1] == self.shape.bases[0][shard]:
                continue
            level = self.file(f"counts1-{shard}")
            place = np.minimum(np.searchsorted(level["keys"], hashes[at]), len(level["keys"]) - 1)
            known = level["keys"][place] == hashes[at]
            ids[at[known]] = place[known] + self.shape.bases[0][shard]
            counts[at[known]] = level["counts"][place[known]]
        return ids, counts

    def of_nodes(self, level: int, name: str, ids: np.ndarray, key: str) -> np.ndarray:
        """Values that the files ``name`` hold for nodes of a level."""
        bases = self.shape.bases[level - 1]
        found = np.zeros(len(ids), np.int64)
        for shard, at in grouped(np.searchsorted(bases, ids, side="right") - 1, len(bases) - 1):
            found[at] = self.file(f"{name}{level}-{shard}")[key][ids[at] - bases[shard]]
        return found

    def left(self, level: int, ids: np.ndarray) -> np.ndarray:
        """log10 of what contexts leave to shorter ones."""
        return self.of_nodes(level, "left", ids, "codes") * -STEP

    def keys(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        return (context.astype(np.uint64) << np.uint64(self.shape.bits)) | token.astype(np.uint64)

    def find(self, level: int, context: np.ndarray, token: np.ndarray,
             left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Node (-1: not kept) and log10 probability of (context, token) in a level above the first; ``left``
        takes what the nodes leave."""
        nodes, logs = np.full(len(context), -1), np.zeros(len(context))
        bases = self.shape.bases[level - 1]
        shards = len(bases) - 1
        for shard, at in grouped(shard_of(mixed(self.keys(context, token), level), shards), shards):
            if bases[shard + 1] == bases[shard]:
                continue
            data = self.file(f"level{level}-{shard}")
            if (level, shard) not in self.sequences:
                self.sequences[level, shard] = EliasFano.loaded(data, "contexts"), EliasFano.loaded(data, "pointers")
            contexts, pointers = self.sequences[level, shard]
            # Neighbours that share their context ask for it once.
            own = context[at]
            new = np.concatenate([[True], own[1:] != own[:-1]])
            place = contexts.find(own[new].astype(np.uint64))
            known = place >= 0
            if not known.any():
                continue
            lo, end = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            lo[known], end[known] = pointers.at_both(place[known])
            asked = np.cumsum(new) - 1
            asked, at = asked[known[asked]], at[known[asked]]
            followers = data["followers"]
            own = token[at].astype(followers.dtype)
            lo = successors(followers.__getitem__, lo[asked], end[asked], own)
            same = followers[lo] == own
            at, lo = at[same], lo[same]
            nodes[at] = lo + bases[shard]
            logs[at] = self.file(f"codes{level}-{shard}")["codes"][lo] * -STEP
            if left is not None:
                left[at] = self.file(f"left{level}-{shard}")["codes"][lo] * -STEP
        return nodes, logs

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.shape.tokens + self.shape.distinct + 1))


@dataclass
class Read:
    """Tokens of some texts: ids, counts, and where each text ends; ``first`` marks first tokens, ``left`` is
    what tokens leave as contexts, if asked for."""

    ids: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    left: np.ndarray


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, bounds = lowered_hashes(texts)
    ends = bounds[1:] + np.arange(len(bounds) - 1)
    word = np.ones(len(flat) + len(ends), bool)
    word[ends] = False
    hashes = np.full(len(word), END)
    hashes[word] = flat
    return hashes, bounds + np.arange(len(bounds))


def read(trie: Trie, texts: pa.Array, with_left: bool = False) -> Read:
    flat, bounds = token_hashes(texts)
    at, number = distinct(flat)
    ids, counts = trie.tokens(flat[at])
    first = np.zeros(len(flat), bool)
    first[bounds[:-1]] = True
    left = np.zeros(len(at))
    if with_left:
        left[ids >= 0] = trie.left(1, ids[ids >= 0])
    return Read(ids[number], counts[number], bounds, first, left[number])


def contexts_of(trie: Trie, text: Read, level: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of tokens that may end an n-gram of ``level``, and the node of the tokens in front of them.

    An n-gram is counted ``min_count`` times only if its parts are, so others need not be counted or looked for."""
    often = text.counts >= min_count
    at = np.flatnonzero(~text.first & often & np.concatenate([[False], often[:-1]]))
    nodes = text.ids[at - 1]
    for k in range(2, level):
        ends = np.zeros(len(text.ids), bool)
        ends[at] = True
        inside = ends[at - 1]
        place = np.full(len(text.ids), -1)
        place[at] = found_nodes(trie, k, nodes, text.ids[at])[0]
        at = at[inside]
        nodes = place[at - 1]
        at, nodes = at[nodes >= 0], nodes[nodes >= 0]
    return at, nodes


def found_nodes(trie: Trie, level: int, context: np.ndarray, token: np.ndarray,
                with_left: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``Trie.find``, asked once for each distinct pair, and what the nodes leave, if asked for."""
    at, number = distinct(trie.keys(context, token))
    left = np.zeros(len(at))
    nodes, logs = trie.find(level, context[at], token[at], left if with_left else None)
    return nodes[number], logs[number], left[number]


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def exchanged(rows: DataFrame, shards: int) -> DataFrame:
    """A task for each shard; by a hash of its number some tasks would get several."""
    return rows.repartitionById(shards, "shard")


def bases_from(rows: list, shards: int) -> np.ndarray:
    sizes = np.zeros(shards + 1, np.int64)
    for r in rows:
        sizes[r["shard"] + 1] = r["n"]
    return np.cumsum(sizes)


def build(spark: SparkSession, train: DataFrame, order: int = 3, min_count: int = 1, discount: float = 0.75,
          shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Shape:
    """Count all n-grams of the training texts and write the trie to the shared folder.

    One pass over the texts per level.  ``shards`` is how many files a level has (by default the number of
    shuffle partitions; levels above the first have more if the texts have more tokens than ``PER_SHARD`` for each); the
    driver learns one size per shard."""
    if not 1 <= order <= 3:
        raise ValueError("levels above the third would need the suffixes of their contexts")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    uri = scratch_path(spark, "ngrams")
    texts = text_rows(train, id_col, text_col)
    shape = Shape(uri, shards, discount, [], min_count=min_count)

    def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(shards, lambda keys: shard_of(keys, shards))
        for part in slices(batches, "text", SLICE):
            yield from tally.add(token_hashes(part.column("text"))[0])
        yield from tally.rows()

    def write_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in by_shard(batches, "<u8"):
            Store(uri).write(f"counts1-{shard}", {"keys": keys, "counts": counts})
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())],
                names=["shard", "n", "total"])

    rows = exchanged(texts.mapInArrow(count_tokens, SENT), shards).mapInArrow(write_tokens, "shard int, n long, total long").collect()
    shape.bases.append(bases_from(rows, shards))
    shape.tokens = sum(r["total"] for r in rows)
    shape.bits = max(1, int(shape.bases[0][-1]).bit_length())
    for level in range(2, order + 1):
        add_level(spark, texts, shape, level, min_count)
    return shape


def add_level(spark: SparkSession, texts: DataFrame, shape: Shape, level: int, min_count: int) -> None:
    uri, discount = shape.uri, shape.discount
    shards, below = shape.shards_of(level), shape.shards_of(level - 1)
    if int(shape.bases[level - 2][-1]).bit_length() + shape.bits > 64:
        raise ValueError("too many contexts for 64-bit keys: raise min_count")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shape)
        tally = Tally(shards, lambda keys: shard_of(mixed(keys, level), shards))
        for part in slices(batches, "text", SLICE):
            text = read(trie, part.column("text"))
            at, nodes = contexts_of(trie, text, level, min_count)
            keys = trie.keys(nodes, text.ids[at])
            del text, at, nodes  # before the tally is merged
            yield from tally.add(keys)
        yield from tally.rows()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write the trie of a shard (contexts, pointers, followers) and its counts; pass on its size (a row
        without keys) and what its n-grams take from their contexts, by the shard of the context."""
        bases = shape.bases[level - 2]
        for shard, keys, counts in by_shard(batches, "<u8"):
            if min_count > 1:
                kept = counts >= min_count
                keys, counts = keys[kept], counts[kept]
            if len(keys):
                context = keys >> np.uint64(shape.bits)
                first = np.flatnonzero(np.diff(context, prepend=~context[:1]))  # in order, as the keys are
                of_level = EliasFano.of(context[first], int(bases[-1])).arrays("contexts")
                del context
                Store(uri).write(f"counts{level}-{shard}", {"counts": counts.astype(np.min_scalar_type(int(counts.max())))})
                Store(uri).write(f"level{level}-{shard}", {
                    **of_level,
                    **EliasFano.of(np.append(first, len(keys)), len(keys) + 1).arrays("pointers"),
                    "followers": (keys & np.uint64((1 << shape.bits) - 1)).astype(np.uint32 if shape.bits <= 32 else np.uint64)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                 pa.array([len(keys)], pa.int64())], names=["shard", "keys", "counts", "n"])
            contexts, taken = summed(keys >> np.uint64(shape.bits), counts - discount)
            for batch in sent(contexts, taken, np.searchsorted(bases, contexts.astype(np.int64), side="right") - 1, below):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None], pa.int64())], names=["shard", "keys", "counts", "n"])

    path = scratch_path(spark, "taken")
    counted = exchanged(texts.mapInArrow(count, SENT), shards).mapInArrow(keep, SENT + ", n long")
    counted.write.parquet(path)
    counted = spark.read.parquet(path)
    bases = bases_from(counted.filter("keys is null").collect(), shards)

    def write_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What contexts leave, for all nodes of a shard of the level below; contexts without kept n-grams leave all."""
        for shard, contexts, taken in by_shard(batches, "<f8"):
            counts = Store(uri).read(f"counts{level - 1}-{shard}")["counts"]
            codes = np.zeros(len(counts), np.uint16)
            at = contexts.astype(np.int64) - shape.bases[level - 2][shard]
            codes[at] = quantised(np.log10(np.maximum(1 - taken / counts[at], 1e-9)))
            Store(uri).write(f"left{level - 1}-{shard}", {"codes": codes})
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

    # A shard whose contexts lead nowhere is not in the rows: every shard starts with a file of zeros.
    def numbers(n: int) -> DataFrame:
        return spark.range(n).select(F.col("id").cast("int").alias("shard"))

    def write_zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                n = int(shape.bases[level - 2][shard + 1] - shape.bases[level - 2][shard])
                Store(uri).write(f"left{level - 1}-{shard}", {"codes": np.zeros(n, np.uint16)})
            yield batch

    numbers(below).mapInArrow(write_zeros, "shard int").count()
    exchanged(counted.filter("keys is not null").drop("n"), below).mapInArrow(write_left, "shard int").count()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The quantised probabilities of a shard."""
        trie = Trie(shape)
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                if bases[shard + 1] == bases[shard]:
                    continue
                data, counts = trie.file(f"level{level}-{shard}"), trie.file(f"counts{level}-{shard}")["counts"]
                contexts, pointers = EliasFano.loaded(data, "contexts"), EliasFano.loaded(data, "pointers")
                ends = pointers.at(np.arange(pointers.n)).astype(np.int64)
                codes = np.empty(len(counts), np.uint16)
                for begin in range(0, len(counts), AT_ONCE):
                    end = min(begin + AT_ONCE, len(counts))
                    # The contexts of these followers; the first and the last may have others.
                    at = np.arange(np.searchsorted(ends, begin, side="right") - 1, np.searchsorted(ends, end))
                    context = contexts.at(at).astype(np.int64)
                    times = np.diff(np.clip(ends[at[0]: at[-1] + 2], begin, end))
                    shorter = log_probability(trie, level - 1, context, times, data["followers"][begin:end].astype(np.int64))
                    p = (counts[begin:end] - discount) / np.repeat(
                        trie.of_nodes(level - 1, "counts", context, "counts"), times) + 10.0 ** (
                        np.repeat(trie.left(level - 1, context), times) + shorter)
                    codes[begin:end] = quantised(np.log10(np.minimum(p, 1.0)))
                Store(uri).write(f"codes{level}-{shard}", {"codes": codes})
            yield batch

    exchanged(numbers(shards), shards).mapInArrow(finish, "shard int").count()
    shape.bases.append(bases)


def log_probability(trie: Trie, level: int, context: np.ndarray, times: np.ndarray, token: np.ndarray) -> np.ndarray:
    """log10 p(token | context without its first token), for contexts that are nodes of ``level``, each with so
    many tokens."""
    at, number = distinct(token.astype(np.uint64))
    single = trie.unigram(trie.of_nodes(1, "counts", token[at], "counts"))[number]
    if level == 1:
        return single
    # The last token of each context, a context of level 1 itself; above level 3 this would be its suffix.
    suffix = trie.of_nodes(level, "level", context, "followers")
    nodes, logs, _ = found_nodes(trie, 2, np.repeat(suffix, times), token)
    return np.where(nodes >= 0, logs, np.repeat(trie.left(1, suffix), times) + single)


def score(docs: DataFrame, shape: Shape, min_count: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every whole text; both scores are log10.

    One row per input row; a null or empty text is its end only; texts alike get scores alike; ids may be
    null; an empty table gives no rows; extra columns are not read.  A model without training texts knows
    no token and gives each of them 1 / 1.  ``min_count`` is that of the model."""
    min_count = shape.min_count if min_count is None else min_count
    rows = text_rows(docs, id_col, text_col)
    order = len(shape.bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shape)
        for part in slices(batches, "text", SLICE):
            text = read(trie, part.column("text"), with_left=order > 1)
            base = trie.unigram(text.counts)
            logs = base.copy()
            often = text.counts >= min_count
            at = np.flatnonzero(~text.first & np.concatenate([[False], often[:-1]])) if order > 1 else np.empty(0, np.int64)
            nodes, left = text.ids[at - 1], text.left[at - 1]
            for level in range(2, order + 1):
                # Tokens behind a known context: the stored probability, or what the context leaves.  Only
                # tokens counted often enough can end a kept n-gram.
                ask = often[at]
                found, stored, leaves = np.full(len(at), -1), np.zeros(len(at)), np.zeros(len(at))
                found[ask], stored[ask], leaves[ask] = found_nodes(trie, level, nodes[ask], text.ids[at[ask]], level < order)
                logs[at] = np.where(found >= 0, stored, logs[at] + left)
                place, left_of = np.full(len(text.ids), -1), np.zeros(len(text.ids))
                place[at], left_of[at] = found, leaves
                at = np.flatnonzero((place[:-1] >= 0) & ~text.first[1:]) + 1
                nodes, left = place[at - 1], left_of[at - 1]
            ends = text.bounds[:-1]
            known_tokens = np.add.reduceat((text.counts > 0).astype(np.int64), ends)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(text.bounds)), pa.array(known_tokens),
                 pa.array(np.add.reduceat(base, ends)), pa.array(np.add.reduceat(logs, ends))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
