"""Words hashed as arrays, orders by one sort, and searches in many ranges at a time."""

import bisect
import re

import numpy as np
import pyarrow as pa
import pytest

from lyceum.llm import elias_fano, ngram_trie, words
from lyceum.llm.elias_fano import EliasFano, successors
from lyceum.llm.mapped import Store

TEXTS = [b"", b"The cat  the\tCAT", None, b" lead and trail\n", b"x", "Äb äB 長い 語".encode(), b"a\x0bb\x0cc\x1cd\x85e\x00f",
         b"", b"12345678 123456789 12345678901234567", b"Z" * 128 + b" " + b"z" * 129 + b" " + b"Z" * 1000, b"   ", None]


def plainly(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or b"").lower())


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
@pytest.mark.parametrize("cut", [slice(None), slice(1, 9), slice(3, 3), slice(10, 12)])
def test_hashes_tell_words_apart(kind, cut):
    array = pa.array([b"other words", *TEXTS], kind).slice(1)[cut]
    found, bounds = words.lowered_hashes(array)
    expected = [plainly(t) for t in TEXTS[cut]]
    assert np.diff(bounds).tolist() == [len(own) for own in expected]
    flat = [w for own in expected for w in own]
    assert len(found) == len(flat) and len(set(zip(flat, found.tolist(), strict=True))) == len(set(flat)) == len(set(found.tolist()))


def test_hashes_do_not_depend_on_the_neighbours():
    draw = np.random.default_rng(2)
    own = [bytes(draw.choice(list(b"abAB\xc3\xa4"), n)) for n in draw.integers(1, 40, 3000)] + [b"q" * n for n in range(1, 300)]
    alone = {w.lower(): int(words.lowered_hashes(pa.array([w]))[0][0]) for w in own}
    together = words.lowered_hashes(pa.array([b" ".join(own[:1000]), b"", b"\n".join(own[1000:])]))[0]
    assert together.tolist() == [alone[w.lower()] for w in own]
    assert len(set(alone.values())) == len(alone)


def test_only_long_words_become_python_objects(monkeypatch):
    """Counting and scoring spent most of their time on an object and a table lookup a word."""
    asked = []
    digest = words.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(words.xxhash, "xxh3_64_intdigest", lambda word: asked.append(len(word)) or digest(word))
    text = b" ".join(b"word%d" % k for k in range(5000)) + b" " + b"w" * 500
    hashes, bounds = ngram_trie.token_hashes(pa.array([text, None, b"one"]))
    assert bounds.tolist() == [0, 5002, 5003, 5005] and asked == [500]
    assert np.flatnonzero(hashes == ngram_trie.END).tolist() == [5001, 5002, 5004]


@pytest.mark.parametrize("values", [
    [], [7], [0, 0, 0], [2**64 - 1, 0, 2**64 - 1, 5], [2**63 + 3, 2**63 + 1, 2**63 + 2, 2**63 + 1],
    np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64), np.random.default_rng(4).integers(0, 900, 5000)])
def test_order_and_distinct(values):
    values = np.array(values, np.uint64)
    assert values[words.order_of(values)].tolist() == sorted(values.tolist())
    at, number = words.distinct(values)
    assert values[at].tolist() == sorted(set(values.tolist())) and values[at][number].tolist() == values.tolist()


def test_places_of_shards():
    for shards in (1, 3, 300, 70_000):
        shard = np.random.default_rng(shards).integers(0, shards, 1000)
        found = {own: at.tolist() for own, at in ngram_trie.grouped(shard, shards)}
        assert found == {own: np.flatnonzero(shard == own).tolist() for own in set(shard.tolist())}
    assert not list(ngram_trie.grouped(np.empty(0, np.int64), 5))


def test_successors():
    draw = np.random.default_rng(6)
    sizes = np.concatenate([[0, 1, 2, 3, 1000, 0], draw.integers(0, 40, 300)])
    end = np.cumsum(sizes)
    begin = end - sizes
    numbers = np.concatenate([np.sort(draw.integers(0, 60, n)) for n in sizes])
    for wanted in range(0, 61, 3):
        place = successors(numbers.__getitem__, begin, end, np.full(len(begin), wanted))
        for b, e, p in zip(begin, end, place, strict=True):
            own = numbers[b:e].tolist()
            assert p == b + bisect.bisect_left(own, wanted) if wanted in own else b <= p <= max(b, e - 1)


@pytest.mark.parametrize("universe", [50, 5000, 10**12])
def test_neighbours_and_bounds(universe):
    values = np.sort(np.random.default_rng(universe % 97).integers(0, universe, 700))
    sequence = EliasFano.of(values, universe)
    one, next_one = sequence.at_both(np.arange(699))
    assert one.tolist() == values[:-1].tolist() and next_one.tolist() == values[1:].tolist()
    high = values >> sequence.width
    below, not_above = sequence.bounds(high)
    assert below.tolist() == np.searchsorted(high, high).tolist()
    assert not_above.tolist() == np.searchsorted(high, high, side="right").tolist()


@pytest.mark.parametrize("n", [0, 1, 4000])
def test_searches_hold_no_copies_of_a_mapped_sequence(tmp_path, n):
    """Lookups in all shards of a level must not add up to an index of the level in a worker."""
    values = np.unique(np.random.default_rng(n).integers(0, 10**6, n)).astype(np.uint64)
    store = Store(str(tmp_path))
    store.write("level", EliasFano.of(values, 10**6).arrays("contexts"))
    arrays = store.read("level")
    sequence = EliasFano.loaded(arrays, "contexts")
    assert sequence.find(values).tolist() == list(range(len(values)))
    assert (sequence.find(np.arange(1000, dtype=np.uint64) * np.uint64(1000)) >= 0).sum() == (values % np.uint64(1000) == 0).sum()
    own = [x for x in vars(sequence).values() if isinstance(x, np.ndarray)]
    assert len(own) == 4 and all(any(x is y or np.shares_memory(x, y) for y in arrays.values()) for x in own if len(x))


def test_packed_values_come_back():
    for values in (np.empty(0, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.arange(5000, dtype=np.uint64) ** np.uint64(4)):
        assert ngram_trie.unpacked(ngram_trie.packed(values), "<u8").tolist() == values.tolist()
    assert ngram_trie.unpacked(ngram_trie.packed(np.array([0.25, -1e9, 3.0])), "<f8").tolist() == [0.25, -1e9, 3.0]


@pytest.mark.parametrize("width", [1, 7, 31, 57, 58, 63])
def test_values_of_any_width(width):
    values = np.random.default_rng(width).integers(0, 1 << width, 500, dtype=np.uint64)
    assert elias_fano.unpacked(elias_fano.packed(values, width), width, np.arange(500)).tolist() == values.tolist()


def test_next_set():
    draw = np.random.default_rng(8)
    bits = draw.integers(0, 2**64, 200, dtype=np.uint64) & draw.integers(0, 2**64, 200, dtype=np.uint64)
    bits = np.concatenate([bits, np.array([0, 2**63, 2**64 - 1], np.uint64)])
    for place in (0, 1, 40, 62, 63):
        found, none = elias_fano.next_set(bits, np.full(len(bits), place))
        behind = [[k for k in range(place + 1, 64) if int(word) >> k & 1] for word in bits]
        assert none.tolist() == [i for i, own in enumerate(behind) if not own]
        assert [int(p) - own[0] for p, own in zip(found, behind, strict=True) if own] == [0] * (len(bits) - len(none))
