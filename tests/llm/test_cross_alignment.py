"""Alignment of two tokenizers against their libraries and plain loops."""

import random
from collections import Counter, defaultdict

import numpy as np
import plain
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from lyceum.llm.cross_alignment import align, alignments, ended, equal_run, link_digests

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
        letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.bytes_a = lambda i: bytes(letters[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a, a)) != raw or b"".join(map(self.bytes_b, b)) != raw:
            return [], []
        return a, b

    def spans(self, ids, size):
        at, found = 0, []
        for i in ids:
            found.append((at, at + len(size(i))))
            at = found[-1][1]
        return found

    def links(self, text):
        a, b = self.tokens(text)
        one, two = self.spans(a, self.bytes_a), self.spans(b, self.bytes_b)
        return [(a[i], b[j]) for i, (s, e) in enumerate(one) for j, (x, y) in enumerate(two) if s < y and x < e]

    def groups(self, text):
        a, b = self.tokens(text)
        ends_a, ends_b = ([e for _, e in self.spans(*x)] for x in ((a, self.bytes_a), (b, self.bytes_b)))
        out, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out


@pytest.fixture(scope="module")
def by_hand():
    return Plain()


def expected_rows(by_hand, rows):
    links = [by_hand.links(t) for _, t in rows]
    held = Counter(p for own in links for p in set(own))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    for (i, t), own in zip(rows, links, strict=True):
        a, b = by_hand.tokens(t)
        groups = by_hand.groups(t)
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (i, len(a), len(b), len(groups), len(own), sum(held[p] == top[p[0]] for p in own), sum(held[p] for p in own),
               plain.sha(listed) if a else "")


ODD = ["", " ", "  ", "a  b", " lead", "trail  ", "\t\ttabs\n\n\nlines \n", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", "\x00\x1c", "🎉🎉 é́ 日本語",
       "x" * 300, "1234567890 3.14159", "don't they're I'll", "　wide　space ", "\r\n" * 5, "﻿bom", "#" * 40 + " " * 40 + "z"]


def mixed_texts(n, seed):
    draw = random.Random(seed)
    signs = ["the", " ", " ", "Straße", "é", "日", "1", "'s", "\n", "\t", "!", "🎉", "ing", "▁" if seed % 2 else "_", "Zug", "  "]
    return ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(n)]


def test_equals_plain_code(spark, table, by_hand):
    rows = plain.corpus() + [(500 + i, t) for i, t in enumerate(ODD + mixed_texts(80, 1) + mixed_texts(80, 2))]
    found = link_digests(spark, table(rows), A, B)
    assert found.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    expected = list(expected_rows(by_hand, rows))
    assert sum(r[1] == 0 for r in expected) > 5 and sum(r[1] > 0 for r in expected) > 150
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_groups_of_ids(table, by_hand):
    rows = [(i, t) for i, t in enumerate(ODD + mixed_texts(60, 3))] + [(None, None), (None, "no id"), (3, "a  b")]
    found = alignments(table(rows), A, B).collect()
    assert sorted(repr((r.doc_id, [(g.a, g.b) for g in r.groups])) for r in found) == sorted(
        repr((i, by_hand.groups(t))) for i, t in rows)


def test_run_skipping():
    draw = random.Random(9)
    for _ in range(3000):
        n = draw.randint(1, 60)
        some = lambda: sorted({*draw.sample(range(1, n + 1), draw.randint(1, n)), n})  # noqa: B023, E731
        ends_a = some()
        ends_b = [e for e in ends_a if draw.random() < 0.9 or e == n] if draw.random() < 0.5 else some()
        found = align(np.array(ends_a), np.array(ends_b))
        common = sorted(set(ends_a) & set(ends_b))
        assert [ends_a[k - 1] for k in found.group_a] == [ends_b[k - 1] for k in found.group_b] == common
        start_a, start_b = [0, *ends_a], [0, *ends_b]
        expected = {(i, j) for i in range(len(ends_a)) for j in range(len(ends_b))
                    if start_a[i] < ends_b[j] and start_b[j] < ends_a[i]}
        assert len(found.link_a) == len(expected) and set(zip(found.link_a.tolist(), found.link_b.tolist())) == expected
    for first in range(70):  # wherever the first difference lies
        a = np.arange(70)
        b = a.copy()
        b[first:] += 1
        assert equal_run(ended(a, 0), ended(b, 1), 0, 0) == first
    assert equal_run(ended(a, 0), ended(a, 1), 0, 0) == 70
    assert equal_run(ended(a, 0), ended(a[3:], 1), 3, 0) == 67
    assert equal_run(ended(a, 0), ended(a[:9], 1), 0, 0) == 9


def test_long_text_and_empty_tables(spark, table, by_hand):
    long = " ".join(mixed_texts(4000, 5)) + " " + "y" * 20_000
    rows = [(1, long), (2, None), (3, "the")]
    got = {r.doc_id: r for r in link_digests(spark, table(rows), A, B).collect()}
    a, b = by_hand.tokens(long)
    assert (got[1].n_a, got[1].n_b) == (len(a), len(b)) and len(long) > 100_000
    assert got[1].n_links == len(a) + len(b) - got[1].n_groups
    assert tuple(got[2]) == (2, 0, 0, 0, 0, 0, 0, "")
    assert link_digests(spark, table([]), A, B).count() == alignments(table([]), A, B).count() == 0


def test_query_over_a_whole_table(spark, by_hand):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in entry_points.queries()["op11_cross_alignment"](spark, sf).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        a, b = by_hand.tokens(text)
        assert (found[i].n_a, found[i].n_b) == (len(a), len(b))
        assert found[i].n_links == (len(a) + len(b) - found[i].n_groups if a else 0)
