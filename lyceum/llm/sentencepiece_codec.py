"""SentencePiece encoding and decoding with a distinct-chunk table.

Where no piece crosses a white-space marker, words are segmented independently of each other: the text
is cut before each run of markers, each distinct marked word is segmented once, and the ids are joined
back by position.  ``check_model`` tests a model for that; other models are refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.chunk_table import ChunkTable
from lyceum.llm.words import slices

MARK = "▁"
# Markers open a word.  A line feed is no part of any piece, so it ends a chunk as well.
CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")

LOADED: dict[str, "Codec"] = {}  # per worker process, so that tasks share what they have segmented


class Codec:
    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.check_model()
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.table = ChunkTable(self.segment)

    def check_model(self) -> None:
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        crossing = [p for p in pieces if MARK in p.lstrip(MARK) or "\n" in p]
        probe = " \tA ﬁ́  x ▁ "
        if crossing or self.library.decode(self.library.encode(probe)) != probe.replace(MARK, " "):
            raise ValueError("pieces cross white-space markers, or texts are normalised: words depend on each other")
        self.before = len(self.library.encode("\n"))

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """A line feed in front takes the marker that the library adds to a text; its ids are cut off."""
        found = self.library.encode(["\n" + c.replace(MARK, " ") for c in chunks], num_threads=1)
        return [ids[self.before:] for ids in found]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        marked = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        begin, end = np.array([self.begin], np.uint32), np.array([self.end], np.uint32)
        return [np.concatenate([begin, ids, end]) for ids in self.table(marked)]

    def decode(self, lists: list[list[int]]) -> list[str]:
        return [self.library.decode(ids) for ids in lists]


def codec(model: str) -> Codec:
    if model not in LOADED:
        LOADED.clear()
        LOADED[model] = Codec(model)
    return LOADED[model]


def encoded_batches(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Keys and ids of (key, text) batches, a bounded piece at a time."""
    own = codec(model)
    for part in slices(batches, "text"):
        yield part.column(0), own.encode(part.column("text").to_pylist())


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text, with begin and end ids: (doc_id, ids array<int>).

    One row per input row, whatever the id; a null text is encoded as an empty one (begin and end only);
    an empty table gives no rows; extra columns are not read.  Texts of any length are encoded whole."""
    rows = keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, lists in encoded_batches(batches, model):
            ids = pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Text of every list of ids, as the library decodes it: (doc_id, text).  A null list gives null."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [None if x is None else own.library.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and report digests instead of ids and texts:
    doc_id, n_tokens, ids_sha256, decoded_sha256.  Cases as in ``encode``."""
    import hashlib

    rows = keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for keys, lists in encoded_batches(batches, model):
            sizes = pa.array([len(x) for x in lists], pa.int64())
            ids = pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists], pa.string())
            texts = (own.library.decode(x.tolist()) for x in lists)
            decoded = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([keys, sizes, ids, decoded],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
