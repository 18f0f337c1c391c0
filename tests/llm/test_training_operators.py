"""Each operator against its plain version, with nulls, repeated rows, empty tables and clashing names."""

import zlib

import plain
import public_tokenizers
import pytest

from lyceum.llm import compression_classifier, ngram_trie
from lyceum.llm.exact_dedup import CHUNK, drop_exact_copies, exact_dedup
from lyceum.llm.near_dedup import drop_near_copies, near_duplicates
from lyceum.llm.packing import pack, pack_histogram
from lyceum.llm.quality_rules import drop_failing, quality_rules
from lyceum.llm.sentencepiece_codec import decode, digests, encode
from lyceum.llm.substring_dedup import substring_dedup

ROWS = plain.corpus()
UNIQUE = list({i: (i, t) for i, t in ROWS if i is not None}.values())
MODEL, WORDS = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json"))


def as_sets(rows):
    return sorted(map(repr, rows))


def test_quality_rules(table):
    found = quality_rules(table(ROWS)).collect()
    assert as_sets((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == as_sets(
        (i, *plain.quality(t)) for i, t in ROWS)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.failed_rules)


def test_quality_rules_drop_rows_whole(table):
    docs = table(ROWS)
    kept = drop_failing(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert kept.count() == quality_rules(docs).filter("kept").count() > 0
    assert drop_failing(table([])).count() == 0


def test_exact_dedup(table):
    found = exact_dedup(table(ROWS)).collect()
    texts = {}
    for i, t in ROWS:
        texts.setdefault(t or "", []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in texts.items()}
    assert as_sets((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == as_sets(
        (i, best[t or ""], len(texts[t or ""]), plain.sha(t or "")) for i, t in ROWS)
    assert sum(r.kept for r in found) == len(texts)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    rows = drop_exact_copies(table(ROWS)).collect()
    assert as_sets((r.doc_id, r.text or "") for r in rows) == as_sets((best[t], t) for t in texts)


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "x" * 9000, "One. Two!\n" * 400, "🎉é\n" * 3000, ("ab. " * 80 + "\n") * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "t", f"array_join(regexp_extract_all(t, r'{CHUNK}', 0), '') AS j",
        f"coalesce(array_max(transform(regexp_extract_all(t, r'{CHUNK}', 0), x -> length(x))), 0) AS m")
    assert all(r.t == r.j and r.m <= 2048 for r in df.collect())


def test_exact_dedup_of_ambiguous_identifiers(table, monkeypatch):
    """With identifiers of two values only, all lists are doubtful, and digests tell them apart."""
    from pyspark.sql import functions as F

    import lyceum.llm.exact_dedup as module

    class Weak:
        def __getattr__(self, name):
            return getattr(F, name)

        @staticmethod
        def xxhash64(*columns):
            return F.pmod(F.xxhash64(*columns), F.lit(2))

    expected = as_sets(tuple(r) for r in exact_dedup(table(ROWS)).collect())
    monkeypatch.setattr(module, "F", Weak())
    assert as_sets(tuple(r) for r in exact_dedup(table(ROWS)).collect()) == expected


def test_substring_dedup(table):
    found = {r.doc_id: tuple(r)[1:] for r in substring_dedup(table(UNIQUE)).collect()}
    assert found == plain.windows(UNIQUE)
    assert sum(n for _, n, _ in found.values()) > 0


@pytest.mark.parametrize("width", [1, 4, 9])
def test_substring_dedup_of_other_widths(table, width):
    found = {r.doc_id: tuple(r)[1:] for r in substring_dedup(table(UNIQUE), width=width).collect()}
    assert found == plain.windows(UNIQUE, width)


def test_substring_dedup_of_repeated_rows(table):
    text = " ".join(f"w{k}" for k in range(30))
    found = substring_dedup(table([(1, text), (1, text), (2, text), (None, text + " x")])).collect()
    assert as_sets((r.doc_id, r.n_removed) for r in found) == as_sets([(None, 0), (1, 30), (1, 30), (2, 30)])
    found = substring_dedup(table([(1, text), (1, text)])).collect()
    assert [r.n_removed for r in found] == [0, 0]
    assert substring_dedup(table([])).count() == 0
    assert substring_dedup(table(ROWS)).count() == len(ROWS)


def test_near_duplicates(spark, table):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark, table(UNIQUE), width=4).collect()}
    assert found == plain.groups(UNIQUE, 4)
    assert sum(i != c for i, (_, c) in found.items()) > 5


def test_near_duplicates_through_chains(spark, table):
    """Neighbours in a chain are alike, its ends are not: all are one group."""
    own = [f"w{k}" for k in range(200)]
    rows = [(100 - k, " ".join(own[:4 * k] + [f"x{j}" for j in range(4 * k)] + own[4 * k:][:200 - 4 * k])) for k in range(12)]
    rows = [(100 - k, " ".join([f"x{j}" for j in range(6 * k)] + own[6 * k:])) for k in range(12)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark, table(rows)).collect()}
    assert found == plain.groups(rows, 5)
    assert {c for _, c in found.values()} == {89}


def test_near_duplicates_of_odd_rows(spark, table):
    found = near_duplicates(spark, table(ROWS), width=4)
    assert found.count() == len(ROWS)
    assert near_duplicates(spark, table([])).count() == 0
    twin = [(None, "a b c d e f"), (7, "A b c d e f"), (3, "a b c  d e f"), (None, "q r s t u v")]
    rows = near_duplicates(spark, table(twin), width=4).collect()
    assert as_sets((r.doc_id, r.component_id, r.kept) for r in rows) == as_sets(
        [(None, 3, False), (7, 3, False), (3, 3, True), (None, None, True)])
    kept = drop_near_copies(spark, table(twin + [(3, "something else entirely")]), width=4).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {3, None}


def test_packing(spark, table):
    from tokenizers import Tokenizer

    size = 64
    tokenizer = Tokenizer.from_file(WORDS)
    rows = pack(spark, table(UNIQUE), WORDS, size=size).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in UNIQUE}
    expected = [(i, k, s, min(size, len(x) - s), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x[s:s + size])))
                for i, x in ids.items() for k, s in enumerate(range(0, len(x), size))]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= 1.03 * sum(r.length for r in rows) / size + 1
    assert pack(spark, table([]), WORDS).count() == 0
    assert pack(spark, table(ROWS), WORDS, size=size).select("doc_id").distinct().count() == len({i for i, _ in ROWS})


def test_packing_of_histograms():
    """At most one sequence more than an exhaustive search finds on small instances, and rarely that."""
    import itertools
    import random

    def best(items, capacity):
        items = sorted(items, reverse=True)
        for n in itertools.count(-(-sum(items) // capacity)):
            rooms = [capacity] * n

            def place(k):
                if k == len(items):
                    return True
                tried = set()
                for b in range(n):
                    if rooms[b] >= items[k] and rooms[b] not in tried:
                        tried.add(rooms[b])
                        rooms[b] -= items[k]
                        if place(k + 1):
                            return True
                        rooms[b] += items[k]
                return False

            if place(0):
                return n

    draw, worse = random.Random(4), 0
    for _ in range(120):
        items = [draw.randint(1, 20) for _ in range(draw.randint(1, 11))]
        counts = {s: items.count(s) for s in items}
        plan = pack_histogram(counts, 20)
        used = {}
        for times, parts in zip(plan.times, plan.parts, strict=True):
            assert sum(s * k for s, k in parts) <= 20
            for s, k in parts:
                used[s] = used.get(s, 0) + times * k
        assert used == counts
        over = sum(plan.times) - best(items, 20)
        assert over <= 1
        worse += over
    assert worse <= 0.1 * 120


def test_sentencepiece(table):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = [(900, " lead"), (901, "a  b   c "), (902, "x\n\n \ny"), (903, "▁a ▁▁"), (904, "\x00\t\r\n"), (905, "z" * 5000)]
    rows = ROWS + odd
    expected = [(i, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in rows]
    assert as_sets((r.doc_id, r.ids) for r in encode(table(rows), MODEL).collect()) == as_sets(expected)
    found = digests(table(rows), MODEL).collect()
    assert as_sets(tuple(r) for r in found) == as_sets(
        (i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), plain.sha(library.decode(ids)))
        for i, ids in expected)
    back = decode(encode(table(odd), MODEL), MODEL).collect()
    assert {r.doc_id: r.text for r in back} == {i: t.replace("▁", " ") for i, t in odd}
    assert digests(table([]), MODEL).count() == 0


def test_compression_classifier(spark, table):
    good = [(i, t) for i, t in plain.corpus(150, seed=5) if i is not None and t and len(t) > 100]
    rows = [(k, t) for k, (_, t) in enumerate(good)] + [(1000 + k, (t + " ").replace(" ", "%%% ")) for k, (_, t) in enumerate(good)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows if i % 3] + [(None, 1), (77_777, 0)], "doc_id long, label int")
    model = compression_classifier.fit(table(rows), labels, dictionary=4096)
    held = [(i, t) for i, t in rows if not i % 3] + [(None, None), (None, "")]
    scores = compression_classifier.score(table(held), model).collect()
    assert len(scores) == len(held) and all(0 <= r.score <= 1 for r in scores)
    right = [(r.score >= 0.5) == (r.doc_id < 1000) for r in scores if r.doc_id is not None]
    assert sum(right) >= 0.85 * len(right)  # very small texts and dictionaries
    assert compression_classifier.score(table([]), model).count() == 0
    none = compression_classifier.fit(table([]), labels)
    assert compression_classifier.score(table(held), none).count() == len(held)


def test_ngram_trie(spark, table):
    train = [(i, t) for i, t in ROWS if i is None or i % 3]
    tokens = lambda t: [*plain.words(plain.lower(t)), "\n"]
    score, base, total, counts = plain.model([tokens(t) for _, t in train])
    shape = ngram_trie.build(spark, table(train), shards=3, min_count=2)
    assert shape.tokens == total and shape.distinct == len(counts)
    found = ngram_trie.score(table(ROWS), shape).collect()
    expected = {}
    for i, t in ROWS:
        own = tokens(t)
        expected.setdefault((i, len(own), sum(counts[w,] > 0 for w in own)), []).append((base(own), score(own)))
    assert len(found) == len(ROWS)
    for r in found:
        options = expected[r.doc_id, r.n_tokens, r.n_known]
        assert any(abs(r.base_score - b) < 1e-6 and abs(r.score - s) < 1e-3 * r.n_tokens for b, s in options)
    assert ngram_trie.score(table([]), shape).count() == 0
    empty = ngram_trie.build(spark, table([]), shards=2, min_count=2)
    assert all(r.n_known == 0 and r.score == 0 for r in ngram_trie.score(table(ROWS[:5]), empty).collect())


def test_probabilities_of_a_context_sum_to_one(spark, table):
    train = [(k, "a b a c a b a d b a b") for k in range(4)]
    shape = ngram_trie.build(spark, table(train), shards=2, min_count=2)
    alone = {r.doc_id: r.score for r in ngram_trie.score(table([(0, "a b")]), shape).collect()}[0]
    rows = [(k, f"a b {w}") for k, w in enumerate(["a", "b", "c", "d", "unknown"])]
    from math import log10

    # score("a b w") - score("a b") + p(end | a b) - p(end | b w) is p(w | a b); the plain model says the same.
    score, _, _, _ = plain.model([[*t.split(), "\n"] for _, t in train])
    for r in ngram_trie.score(table(rows), shape).collect():
        assert abs(r.score - score(["a", "b", rows[r.doc_id][1].split()[2], "\n"])) < 0.01
    assert abs(alone - score(["a", "b", "\n"])) < 0.01
    own = [score(["a", "b", w]) - score(["a", "b"]) for w in ["a", "b", "c", "d", "\n", "unknown"]]
    assert abs(log10(sum(10**x for x in own))) < 1e-9
