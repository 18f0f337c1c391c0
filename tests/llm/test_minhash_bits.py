"""Rows of mixed buckets carry a few words of minhash bits instead of the sketches of large sets; they lose no pair alike enough."""

import numpy as np
import pytest

from lyceum.llm import near_dedup
from lyceum.llm.words import mixed


def apart(one, two):
    bounds = np.arange(len(one) + 1) * one.shape[1]
    bits = near_dedup.minhash_bits(one.ravel(), bounds) ^ near_dedup.minhash_bits(two.ravel(), bounds)
    return np.bitwise_count(bits.view(np.uint64)).sum(axis=1)


@pytest.mark.parametrize("size", [1, 9, 90, 900])
def test_alike_sets_differ_in_few_bits(size):
    values = mixed(np.arange(400 * 2 * size, dtype=np.uint64), 3).reshape(400, 2 * size)
    common = -(-8 * 2 * size // 18)  # of two sets of one size: 8 of 10 in the union
    one, two = values[:, :size], np.hstack([values[:, :common], values[:, size:2 * size - common]])
    assert apart(one, two).max() <= near_dedup.most_apart(80) < apart(one, values[:, size:]).min()


def test_rows_of_mixed_buckets_are_small(spark, table, monkeypatch):
    """A sketch of all its 256 members in each of a member's rows was most of what the query shuffled."""
    seen = []
    plainly = near_dedup.pairs_apart

    def looked(rows, percent):
        seen.extend(r.asDict() for r in rows.collect())
        return plainly(rows, percent)

    monkeypatch.setattr(near_dedup, "pairs_apart", looked)
    text = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(w if k % 11 or not i else f"x{i}-{k}" for k, w in enumerate(text))) for i in range(40)]
    assert all(r.kept for r in near_dedup.near_duplicates(spark, table(rows), width=4).collect())
    assert seen and all(r["n_shingles"] > near_dedup.SKETCH and not r["sketch"] and len(r["bits"]) <= 16 for r in seen)
