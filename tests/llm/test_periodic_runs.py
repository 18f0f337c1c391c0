"""Periodic runs against a search of every period, and the query against its own plain version."""

import random
import zlib

import plain
import pytest

import __spark_entry__ as entry_points
from lyceum.llm.periodic_runs import Automaton, LastPlaces, collapsed, periodic_runs, runs_of, squares, stretches


def every_period(words, least_length=6, least_exponent=4):
    """Maximal stretches of each period, less those that a smaller period fits as well."""
    n, found = len(words), []
    for period in range(1, n // least_exponent + 1):
        start = 0
        while start + period < n:
            end = start + period
            while end < n and words[end] == words[end - period]:
                end += 1
            smaller = any(all(words[i] == words[i + p] for i in range(start, end - p)) for p in range(1, period))
            if end - start >= max(least_length, least_exponent * period) and not smaller:
                found.append((start, end - start, period))
            start = end - period + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        words = [draw.choice("abcd"[: draw.randint(1, 4)]) for _ in range(draw.randint(0, 45))]
        for _ in range(draw.randint(0, 2)):
            if words:
                at, period = draw.randrange(len(words)), draw.randint(1, 7)
                words[at:at] = words[at : at + period] * draw.randint(1, 6)
        yield words


def test_equals_a_search_of_every_period():
    for words in repetitive(1500, 3):
        for least in (2, 3, 4):
            assert runs_of(words, 6, least) == every_period(words, 6, least), words


def test_cutting_loses_no_run():
    for words in repetitive(500, 4):
        uncut = [(s, e - s, p) for (s, p), e in squares(words).items() if e - s >= max(6, 4 * p)]
        assert sorted(uncut, key=lambda r: (r[0], r[2])) == runs_of(words)
        for low, high in stretches(words, 6, 4):
            assert 0 <= low < high <= len(words)


def test_recolouring_finds_the_last_place_of_each_suffix():
    for words in repetitive(200, 5):
        automaton = Automaton(words)
        tree = LastPlaces(automaton.link)
        for place, node in enumerate(automaton.prefixes, 1):
            met = {automaton.length[x]: before for x, before in tree.recolour(node, place)}
            ends = {size: max((e for e in range(size, place) if words[e - size : e] == words[place - size : place]), default=0)
                    for size in range(1, place + 1)}
            # The longest suffix that ended last at a place stands for all that did.
            expected = {max(s for s in ends if ends[s] == e): e for e in set(ends.values()) if e}
            assert {s: e for s, e in met.items() if s} == expected


def test_long_runs_and_many_periods():
    assert runs_of(["ta"] * 30_000) == [(0, 30_000, 1)]
    assert runs_of([str(i % 999) for i in range(30_000)]) == [(0, 30_000, 999)]
    nested = (["a"] * 6 + ["b"]) * 5
    assert runs_of(nested) == every_period(nested) and len(runs_of(nested)) == 6


def test_collapsed():
    assert collapsed("x a b a b a b a b a y".split(), [(1, 9, 2)]) == "x a b y".split()
    words = "u v".split()
    assert collapsed(words, []) is words


def made_periodic(i, words):
    h = zlib.crc32(("" if i is None else str(i)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + int((n - a) / (3 + g % 8))
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    return words


def row(i, text):
    words = made_periodic(i, plain.words(text))
    runs = every_period(words)
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return i, len(runs), *top, plain.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), plain.sha(" ".join(kept))


@pytest.fixture
def documents(table, tmp_path):
    def write(rows):
        table(rows).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)
    return write


def test_query_equals_plain_code(spark, documents):
    rows = plain.corpus() + [(2000 + i, " ".join(w)) for i, w in enumerate(repetitive(150, 6))]
    found = entry_points.queries()["op12_periodic_runs"](spark, documents(rows))
    assert found.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert {t for c, t in found.dtypes if not c.endswith("sha256")} == {"bigint"}
    expected = [row(i, t) for i, t in rows]
    assert sum(r[1] > 0 for r in expected) > 20
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_spans_nulls_and_empty_tables(table):
    text = "no no no no no no yes"
    got = {r.doc_id: r for r in periodic_runs(table([(1, text), (2, None), (3, ""), (None, "one")])).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 6, 1)] and got[1].collapsed == "no yes" and got[1].n_words == 7
    for i in (2, 3):
        assert (got[i].n_words, got[i].runs, got[i].collapsed) == (0, [], "")
    assert got[None].collapsed == "one"
    assert periodic_runs(table([])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(table([]), least_exponent=1)
