"""Byte-level BPE against the library on whole texts, and a plain merge loop on its own."""

import hashlib
import random

import plain
import public_tokenizers
import regex
import tiktoken

import __spark_entry__ as entry_points
from lyceum.llm.byte_bpe_codec import ByteCodec, decode, digests, encode, read_ranks

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TABLE = read_ranks(RANKS)
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=TABLE, special_tokens={})


def merged(piece):
    """Join the adjacent pair of lowest rank, leftmost first, until no pair has one."""
    parts = [bytes([b]) for b in piece]
    while True:
        ranked = [(TABLE[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in TABLE]
        if not ranked:
            return [TABLE[p] for p in parts]
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def by_hand(text):
    return [i for match in regex.findall(PATTERN, text or "") for i in merged(match.encode())]


def row(i, text):
    ids = by_hand(text)
    listed = ",".join(map(str, ids))
    return i, len(ids), plain.sha(listed), plain.sha(text or "")


def random_texts(n, seed):
    draw = random.Random(seed)
    signs = ["a", "B", "é", "日", "1", "٣", "'s", "'", " ", "  ", "\n", "\t", "　", "\x85", "\x1c", "!", "🎉", "́", " ", "the"]
    return ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(n)]


def test_equals_plain_code(table):
    rows = plain.corpus() + [(1000 + i, t) for i, t in enumerate(random_texts(300, 5))]
    found = digests(table(rows), RANKS, PATTERN).collect()
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(map(repr, (row(i, t) for i, t in rows)))


def test_parts_give_the_ids_of_the_whole():
    own = ByteCodec(TABLE, PATTERN, part=7, run=3)
    for text in random_texts(4000, 6):
        assert "".join(p for p, _ in own.parts(text)) == text
        assert own.encode(text) == LIBRARY.encode_ordinary(text), repr(text)


def test_very_long_texts(table):
    """Runs of white space that stop the library's own matcher, one endless word, and a long text."""
    prose = "Die Straße, it's 1984 times…  longer.\n\n" * 30_000
    texts = [" " * 1_200_000, "\n" * 1_100_000 + "word", "x" + "\t " * 600_000 + " y", "ab" * 500_000, prose]
    got = {r.doc_id: r for r in encode(table(list(enumerate(texts))), RANKS, PATTERN).collect()}
    back = {r.doc_id: bytes(r.bytes) for r in decode(encode(table(list(enumerate(texts))), RANKS, PATTERN), RANKS, PATTERN).collect()}
    for i, text in enumerate(texts):
        assert back[i] == text.encode()
    assert got[3].ids == LIBRARY.encode_ordinary(texts[3]) and got[4].ids == LIBRARY.encode_ordinary(texts[4])
    assert got[0].ids == tiktoken.Encoding("w", pat_str="(?s:.+)", mergeable_ranks=TABLE, special_tokens={}).encode_ordinary(texts[0])
    assert got[1].ids[-1:] == LIBRARY.encode_ordinary("word") and len(got[1].ids) > 1


def test_round_trip_nulls_and_empty_tables(spark, table):
    rows = [(1, None), (2, ""), (2, ""), (None, "<|endoftext|> é"), (3, "\x00�")]
    ids = encode(table(rows), RANKS, PATTERN)
    assert [r.ids for r in ids.filter("doc_id = 1 or doc_id = 2").collect()] == [[], [], []]
    back = sorted(bytes(r.bytes) for r in decode(ids, RANKS, PATTERN).collect())
    assert back == sorted((t or "").encode() for _, t in rows)
    assert encode(table([]), RANKS, PATTERN).count() == digests(table([]), RANKS, PATTERN).count() == 0
    lists = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.bytes) for r in decode(lists, RANKS, PATTERN).collect()) == [(1, None), (2, b"")]
    # Bytes that are no text come back as they are.
    single = [TABLE[bytes([b])] for b in (0xFF, 0xC3, 0x28)]
    lists = spark.createDataFrame([(1, single)], "doc_id long, ids array<int>")
    assert bytes(decode(lists, RANKS, PATTERN).first().bytes) == b"\xff\xc3("


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in entry_points.queries()["op13_byte_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids = LIBRARY.encode_ordinary(d.text or "")
        assert tuple(found[d.doc_id]) == (d.doc_id, len(ids), plain.sha(",".join(map(str, ids))),
                                          hashlib.sha256((d.text or "").encode()).hexdigest())
