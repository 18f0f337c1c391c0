"""Near duplicates in rounds: no link is lost, and a hot group costs about as many comparisons as it has members."""

import random

import plain
import pytest

from lyceum.llm import near_dedup


def shingles(text, width):
    own = [w for w in plain.words(plain.lower(text))]
    return {tuple(own[i:i + width]) for i in range(len(own) - width + 1)} or ({tuple(own)} if own else set())


def reachable(rows, width, percent):
    """Smallest id that links lead to, by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def edited_copies(n, seed, edits, length=80, first=0):
    """Copies of one text, each with some words of its own."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10_000)}" for _ in range(length)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(draw.randint(0, edits)):
            words[draw.randrange(length)] = f"x{draw.randrange(10**9)}"
        rows.append((first + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("edits", [2, 4, 6])
def test_no_link_is_lost(spark, table, edits):
    rows = edited_copies(90, edits, edits) + edited_copies(90, 10 + edits, 2 * edits, first=1000) + plain.corpus()[:40]
    rows = list({i + 5000 if k >= 180 else i: (i + 5000 if k >= 180 else i, t) for k, (i, t) in enumerate(rows)}.values())
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark, table(rows), width=4).collect()}
    assert found == reachable(rows, 4, 80)


def compared(spark, table, rows, monkeypatch):
    """How many pairs go to the rounds of smallest members, and how many are confirmed on whole sets."""
    counts = {"hopeful": 0, "confirmed": 0}
    for name in counts:
        plainly = getattr(near_dedup, name)

        def counted(pairs, *rest, name=name, plainly=plainly):
            counts[name] += pairs.count()
            return plainly(pairs, *rest)

        monkeypatch.setattr(near_dedup, name, counted)
    near_dedup.near_duplicates(spark, table(rows), width=4)
    monkeypatch.undo()
    return counts


def test_comparisons_grow_with_the_members(spark, table, monkeypatch):
    """Two edits leave a copy alike to its text, and pairs of copies need not be compared.  With six, most are
    alike to nothing: in the rounds they meet a fixed number of others, at last all that share a bucket."""
    alike = compared(spark, table, edited_copies(300, 3, 2), monkeypatch)
    assert alike["confirmed"] <= 2 * near_dedup.HUBS * 300, alike
    apart = compared(spark, table, edited_copies(300, 3, 6), monkeypatch)
    assert max(alike["hopeful"], apart["hopeful"]) <= 2 * near_dedup.HUBS * 300, (alike, apart)


def test_pairs_of_components_meet_once(spark):
    """Every pair of different components in a bucket, in the first bucket that it shares; no pair inside one."""
    keys = {rep: [100, 200 + rep % 2] + [900 + rep * 50 + k for k in range(2)] for rep in range(12)}  # place 0 is common to all
    component = {rep: 0 if rep < 8 else rep for rep in keys}
    rows = [(k * 1000 + keys[rep][k], k, rep, component[rep], 5, [1, 2, 3, 4, 5], keys[rep][:k]) for rep in keys for k in range(4)]
    marked = spark.createDataFrame(rows, "bucket long, k int, rep long, component long, n_shingles long, sketch array<smallint>, before array<long>")
    mixed = near_dedup.mixed_buckets(marked)
    assert {r.main for r in mixed.collect()} == {0}
    found = [tuple(sorted(r)) for r in near_dedup.pairs_apart(mixed.drop("k"), 80).collect()]
    assert sorted(found) == sorted((a, b) for a in keys for b in keys if a < b and component[a] != component[b])
    assert near_dedup.pairs_apart(mixed.drop("k").filter("false"), 80).count() == 0
