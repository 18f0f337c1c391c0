"""Substring dedup by difference-cover anchors.

A window of ``width`` words that occurs twice need not be aligned the same way at both places.  With a
difference cover D of a period v (every distance is a difference of two elements, modulo v), any two
positions have a common shift below v after which both stand at a position in D.  So it is enough to hash
anchors of width - v + 1 words at positions in D modulo v, counted from the start of each document: two
equal windows hold an equal aligned anchor.  Anchors found once lead nowhere; around the others the windows
that hold them are hashed whole, and of equal windows all but the first are marked.

Tasks exchange sorted arrays of hashes.  What a task sees twice itself it settles itself, so a hash goes out
once per task, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Generator, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.words import WORD, Hashes, hashed, ragged, rolled, slices, starts_inside

# Perfect difference sets, period to elements.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
FLUSH = 1_000_000  # entries that a task holds before it sends them on


def cover_for(width: int) -> int:
    """The longest period that leaves anchors of a third of the window."""
    return max(v for v in COVERS if width - v + 1 >= max(1, width // 3))


def spread(entries: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Entries by bucket of their keys; the bucket is taken from the upper bits."""
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    if len(entries):
        for part, at in zip(np.split(entries, cuts), np.concatenate([[0], cuts]), strict=True):
            yield int(bucket[at]), part


ANCHOR = np.dtype([("hash", "<u8"), ("doc", "<i4"), ("at", "<i4")])
WINDOW = np.dtype([("hash", "<u8"), ("more", "<u4"), ("doc", "<i4"), ("at", "<i4")])  # 96 bits of hash
PLACE = np.dtype([("doc", "<i4"), ("at", "<i4")])
SENT = "bucket int, docs array<struct<id:{id},tie:bigint>>, entries binary"
HITS = "doc_id {id}, tie bigint, places binary"


def packed(entries: np.ndarray) -> bytes:
    """Entries, in order of document and place, column by column.  Steps between documents and places are
    small, so their bytes are laid out by significance and compress to little; hashes do not."""
    import zstandard

    parts = [np.int64(len(entries)).tobytes()]
    for name in ("doc", "at"):
        steps = np.diff(entries[name], prepend=np.int32(0)).astype("<i4")
        parts.append(steps.view(np.uint8).reshape(-1, 4).T.tobytes())
    parts += [entries[name].tobytes() for name in entries.dtype.names if name not in ("doc", "at")]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blob: bytes, dtype: np.dtype) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int(np.frombuffer(raw, "<i8", 1)[0]), 8
    entries = np.empty(n, dtype)
    for name in ("doc", "at"):
        steps = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view("<i4").ravel()
        entries[name] = np.cumsum(steps, dtype=np.int32)
        at += 4 * n
    for name in dtype.names:
        if name not in ("doc", "at"):
            entries[name] = np.frombuffer(raw, dtype[name], n, at)
            at += dtype[name].itemsize * n
    return entries


def by_document(doc: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Places of each document as bytes."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order].astype("<i4")
    cuts = np.flatnonzero(np.diff(doc)) + 1
    if len(doc):
        for places, first in zip(np.split(at, cuts), np.concatenate([[0], cuts]), strict=True):
            yield int(doc[first]), places.tobytes()


def by_bucket_of_document(doc: np.ndarray, at: np.ndarray, docs: list[tuple], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places by the bucket of their document."""
    places = np.empty(len(doc), PLACE)
    places["doc"], places["at"] = doc, at
    own = np.array([xxhash.xxh3_64_intdigest(repr(d).encode()) for d in docs], np.uint64)
    return spread(places, own[places["doc"]], buckets)


def sealed(rows: Iterable[tuple[int, np.ndarray]], docs: list[tuple], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows to send: bucket, the documents that its entries mention, and the entries, packed."""
    rows = list(rows)
    for first in range(0, len(rows), 64):
        buckets, mentioned, blobs = [], [], []
        for bucket, part in rows[first:first + 64]:
            used, local = np.unique(part["doc"], return_inverse=True)
            part = part.copy()
            part["doc"] = local
            buckets.append(bucket)
            mentioned.append([{"id": docs[d][0], "tie": docs[d][1]} for d in used])
            blobs.append(packed(part))
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets, pa.int32()),
             pa.array(mentioned, pa.list_(pa.struct([("id", kind), ("tie", pa.int64())]))),
             pa.array(blobs, pa.binary())], names=["bucket", "docs", "entries"])


class Sender:
    """Collects entries of a task and the documents they are from; sends them on by bucket.

    A sent row has the entries of one bucket and the documents they mention; a row with bucket -1 - k
    carries places that need no answer, which no other entry has to meet: their bucket is that of the
    document, so that a passage of many documents is spread over all tasks."""

    def __init__(self, kind: pa.DataType, dtype: np.dtype, buckets: int):
        self.kind, self.dtype, self.buckets = kind, dtype, buckets
        self.docs: list[tuple] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, docs: list[tuple], entries: np.ndarray) -> None:
        entries["doc"] += len(self.docs)
        self.docs += docs
        self.parts.append(entries)
        self.size += len(entries)

    def rows(self) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate(self.parts) if self.parts else np.empty(0, self.dtype)
        out, known = self.settle(entries)
        yield from sealed(spread(out, out["hash"], self.buckets), self.docs, self.kind)
        dealt = by_bucket_of_document(known["doc"], known["at"], self.docs, self.buckets)
        yield from sealed(((-1 - bucket, part) for bucket, part in dealt), self.docs, self.kind)
        self.docs, self.parts, self.size = [], [], 0

    def settle(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError


class Anchors(Sender):
    """An anchor that this task has twice is repeated for sure; one of them goes out, to tell others."""

    def settle(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, first, inverse, counts = np.unique(entries["hash"], return_index=True, return_inverse=True, return_counts=True)
        return entries[np.sort(first)], entries[counts[inverse] > 1]


class Windows(Sender):
    """Of equal windows of this task only the first goes out; the others are not first for sure."""

    def settle(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order, first, same = first_of_each(entries, self.docs)
        return entries[np.sort(order[first])], entries[np.sort(order[~first & ~same])]


def rank_of(docs: list[tuple]) -> np.ndarray:
    """Place of each document in the order (null ids first, id, tie); equal for rows alike."""
    keys = [((d[0] is not None), d[0] if d[0] is not None else 0, d[1]) for d in docs]
    place = {k: i for i, k in enumerate(sorted(set(keys)))}
    return np.array([place[k] for k in keys], np.int64)


def first_of_each(entries: np.ndarray, docs: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (window, document, place); which is the first of its window; which is the same place as
    the first (rows alike in id and text)."""
    rank = rank_of(docs)[entries["doc"]] if len(entries) else np.empty(0, np.int64)
    order = np.lexsort((entries["at"], rank, entries["more"], entries["hash"]))
    e, rank = entries[order], rank[order]
    first = np.ones(len(e), bool)
    first[1:] = (e["hash"][1:] != e["hash"][:-1]) | (e["more"][1:] != e["more"][:-1])
    lead = np.maximum.accumulate(np.where(first, np.arange(len(e)), 0)) if len(e) else np.empty(0, np.int64)
    return order, first, (rank == rank[lead]) & (e["at"] == e["at"][lead]) & ~first


def received(batches: Iterable[pa.RecordBatch], dtype: np.dtype) -> Generator[pa.RecordBatch, None, tuple[np.ndarray, list[tuple]]]:
    """Passes settled places on as they come, still packed; gives back all other entries of a task and
    their documents."""
    parts, docs = [], []
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        settled = pa.array(buckets < 0)
        passed = batch.filter(settled)
        if passed.num_rows:
            own = pa.array(-1 - buckets[buckets < 0], pa.int32())
            yield pa.RecordBatch.from_arrays([own, passed.column("docs"), passed.column("entries")], names=batch.schema.names)
        for some, blob in opened(batch.filter(pc.invert(settled))):
            part = unpacked(blob, dtype)
            part["doc"] += len(docs)
            docs += some
            parts.append(part)
    return np.concatenate(parts) if parts else np.empty(0, dtype), docs


def opened(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple], bytes]]:
    for some, blob in zip(batch.column("docs").to_pylist(), batch.column("entries").to_pylist(), strict=True):
        yield [(d["id"], d["tie"]) for d in some], blob


def exchanged(sent: DataFrame, buckets: int) -> DataFrame:
    return sent.repartition(buckets, F.when(F.col("bucket") < 0, -1 - F.col("bucket")).otherwise(F.col("bucket")))


def gathered(answers: DataFrame, buckets: int, kind: str) -> DataFrame:
    """All places of a document in one row: doc_id, tie, places.  Answers come packed, a row from each task
    to each bucket of documents, so that no row is made for each document and task."""
    id_type = arrow_type(kind)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}
        doc, at = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for batch in batches:
            for some, blob in opened(batch):
                part = unpacked(blob, PLACE)
                own = np.array([known.setdefault(d, len(known)) for d in some], np.int64)
                doc.append(own[part["doc"]])
                at.append(part["at"])
        docs = list(known)
        rows = list(by_document(np.concatenate(doc), np.concatenate(at)))
        for k in range(0, len(rows), 10_000):
            some = rows[k:k + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([docs[d][0] for d, _ in some], id_type), pa.array([docs[d][1] for d, _ in some], pa.int64()),
                 pa.array([p for _, p in some], pa.binary())], names=["doc_id", "tie", "places"])

    return answers.repartition(buckets, "bucket").mapInArrow(merge, HITS.format(id=kind))


def with_places(docs: DataFrame, found: DataFrame) -> DataFrame:
    own = found.select(F.col("doc_id").alias("own_id"), F.col("tie").alias("own_tie"), "places")
    return docs.join(own, docs["doc_id"].eqNullSafe(own["own_id"]) & (docs["tie"] == own["own_tie"]), "left").select(
        "doc_id", "tie", "text", "places")


def arrow_type(ddl: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[ddl]


def places_of(value: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(value, "<i4"))


def repeated_windows(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with the starts of their windows that also start earlier: (doc_id, tie, text, places)
    with ``text`` in UTF-8 and ``places`` a binary array (little-endian 32-bit word positions), null if there are none.

    Earlier is a smaller id (null ids come first), or the same document and an earlier word.  Rows with
    one id and different texts count as different documents, in an order fixed by a hash of the text
    (``tie``); rows alike in id and text are one document, so neither makes the other's windows repeated."""
    kind = dict(docs.dtypes)[id_col]
    id_type = arrow_type(kind)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit("").cast("binary")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    period = cover_for(width)
    offsets, anchor = np.array(COVERS[period]), width - period + 1
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sender = Hashes(), Anchors(id_type, ANCHOR, buckets)
        for part in slices(batches, "text"):
            flat, bounds = hashed([WORD.findall(t) for t in part.column("text").to_pylist()], table)
            own = rolled(flat, anchor, seed=anchor)
            doc = np.repeat(np.arange(len(bounds) - 1), np.maximum(np.diff(bounds) - anchor + 1, 0))
            start = starts_inside(bounds, anchor)
            at = start - bounds[doc]
            keep = np.isin(at % period, offsets) & (np.diff(bounds)[doc] >= width)
            entries = np.empty(int(keep.sum()), ANCHOR)
            entries["hash"], entries["doc"], entries["at"] = own[start[keep]], doc[keep], at[keep]
            sender.add(list(zip(part.column("doc_id").to_pylist(), part.column("tie").to_pylist(), strict=True)), entries)
            if sender.size >= FLUSH:
                yield from sender.rows()
        yield from sender.rows()

    def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, documents = yield from received(batches, ANCHOR)
        _, inverse, counts = np.unique(entries["hash"], return_inverse=True, return_counts=True)
        found = entries[counts[inverse] > 1]
        yield from sealed(by_bucket_of_document(found["doc"], found["at"], documents, buckets), documents, id_type)

    def find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sender = Hashes(), Windows(id_type, WINDOW, buckets)
        for part in slices(batches, "text"):
            flat, bounds = hashed([WORD.findall(t) for t in part.column("text").to_pylist()], table)
            one, two = rolled(flat, width, seed=101), rolled(flat, width, seed=202)
            starts, owner = [], []
            for i, places in enumerate(part.column("places").to_pylist()):
                at = places_of(places)
                low = np.maximum(at + anchor - width, 0)
                high = np.minimum(at, bounds[i + 1] - bounds[i] - width)
                own = np.unique(ragged(low, np.maximum(high - low + 1, 0)))
                starts.append(own)
                owner.append(np.full(len(own), i))
            at, doc = np.concatenate(starts), np.concatenate(owner)
            entries = np.empty(len(at), WINDOW)
            entries["hash"], entries["more"] = one[bounds[doc] + at], two[bounds[doc] + at]
            entries["doc"], entries["at"] = doc, at
            sender.add(list(zip(part.column("doc_id").to_pylist(), part.column("tie").to_pylist(), strict=True)), entries)
            if sender.size >= FLUSH:
                yield from sender.rows()
        yield from sender.rows()

    def later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, documents = yield from received(batches, WINDOW)
        order, first, same = first_of_each(entries, documents)
        later = entries[order][~first & ~same]
        yield from sealed(by_bucket_of_document(later["doc"], later["at"], documents, buckets), documents, id_type)

    sent = SENT.format(id=kind)
    anchors = exchanged(texts.mapInArrow(find_anchors, sent), buckets).mapInArrow(repeated_anchors, sent)
    suspects = with_places(texts, gathered(anchors, buckets, kind)).filter(F.col("places").isNotNull())
    windows = exchanged(suspects.mapInArrow(find_windows, sent), buckets).mapInArrow(later_windows, sent)
    return with_places(texts, gathered(windows, buckets, kind))


def removed_mask(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:-1]) > 0


def substring_dedup(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts earlier.

    Returns one row per input row: doc_id, n_words, n_removed, kept_text (the kept words joined by one
    space).  Null and empty texts have no words; texts shorter than ``width`` lose none; for null ids,
    repeated ids and repeated rows see ``repeated_windows``; an empty table gives no rows; extra columns
    are not read."""
    marked = repeated_windows(docs, width, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sizes, removed, kept = [], [], []
            for text, places in zip(part.column("text").to_pylist(), part.column("places").to_pylist(), strict=True):
                words, n = WORD.findall(text), 0
                sizes.append(len(words))
                if places:
                    gone = removed_mask(len(words), places_of(places), width)
                    n = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                removed.append(n)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return marked.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string")


def substring_digests(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``substring_dedup`` with the digest of the kept text in place of the text."""
    return substring_dedup(docs, width, id_col, text_col).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
