"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The library splits a text by a pattern and merges each match by itself.  Long texts are given to it in
parts, which keeps its pattern matcher within its stack: a part ends between a character that is no white
space and one that is, where the pattern ends a match whatever follows.
A very long run of white space is one match (less its last character, where a word follows), so it is
merged as a whole without the pattern.  Decoding joins the bytes of the ids; nothing is replaced."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.words import slices

# Fixed value: the characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
BOUNDARY = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
PART = 50_000  # characters of a part, about
RUN = 10_000  # white space merged without the pattern

LOADED: dict[tuple[str, str], "ByteCodec"] = {}  # per worker process


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 text and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, part: int = PART, run: int = RUN):
        import tiktoken

        self.by_pattern = tiktoken.Encoding("by-pattern", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.as_whole = tiktoken.Encoding("as-whole", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.part, self.run = part, re.compile(f"[{WHITE}]{{{run},}}")
        self.longest_run = run
        self.digits = [str(i) for i in range(max(ranks.values()) + 1)]

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in parts whose ids do not depend on each other, and whether one is a single match."""
        at = 0
        for found in self.run.finditer(text):
            start, end = found.span()
            yield from ((p, False) for p in self.cut(text[at:start]))
            at = end if end == len(text) else end - 1
            yield text[start:at], True
        yield from ((p, False) for p in self.cut(text[at:]))

    def cut(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > self.part:
            found = BOUNDARY.search(text, at + self.part)
            if found is None:
                break
            yield text[at : found.start()]
            at = found.start()
        if at < len(text):
            yield text[at:] if at else text

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; strings of special tokens are ordinary text."""
        if not text:
            return []
        if len(text) <= self.part and len(text) < self.longest_run:
            return self.by_pattern.encode_ordinary(text)
        ids: list[int] = []
        for part, whole in self.parts(text):
            ids += (self.as_whole if whole else self.by_pattern).encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.by_pattern.decode_bytes(ids)

    def listed(self, ids: list[int]) -> str:
        return ",".join(map(self.digits.__getitem__, ids))


def codec(ranks: str, pattern: str) -> ByteCodec:
    if (ranks, pattern) not in LOADED:
        LOADED.clear()
        LOADED[ranks, pattern] = ByteCodec(read_ranks(ranks), pattern)
    return LOADED[ranks, pattern]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text by the rank file ``ranks``: (doc_id, ids array<int>).

    Each match of ``pattern`` is merged by itself, without special tokens.  One row per input row, whatever
    the id, repeated ones too; null and empty texts have no ids; an empty table gives no rows; extra columns
    are not read.  The pattern has to end every match between a character that is no white space and one
    that is, and has to take a run of white space as one match, but for a last character before a word."""
    rows = keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for part in slices(batches, "text"):
            ids = pa.array([own.encode(t) for t in part.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Raw bytes of every list of ids: (doc_id, bytes).  A null list gives null, an empty one no bytes."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            found = [None if ids is None else own.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "bytes"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, bytes binary")


def digests(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded bytes).  Cases as in ``encode``."""
    rows = keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for part in slices(batches, "text"):
            sizes, ids_sha, decoded_sha = [], [], []
            for text in part.column("text").to_pylist():
                ids = own.encode(text)
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(own.listed(ids).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
