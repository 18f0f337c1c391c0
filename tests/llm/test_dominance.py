"""Packing fixes only sets that dominate: instances whose best number of sequences is known."""

import itertools

import pytest

from lyceum.llm.packing import Lengths, best_pair, pack_histogram


@pytest.mark.parametrize("capacity,counts,sequences", [
    (20, {14: 1, 8: 1, 7: 1, 5: 1, 2: 3}, 2),                          # 14 + 2 + 2 + 2, 8 + 7 + 5
    (2048, {1500: 1000, 500: 1000, 180: 3000, 774: 2000}, 2000),       # 1500 + 3 x 180, 774 + 774 + 500
])
def test_number_of_sequences(capacity, counts, sequences):
    plan = pack_histogram(counts, capacity)
    assert all(sum(s * k for s, k in parts) <= capacity for parts in plan.parts)
    assert sum(plan.times) == sequences


def test_best_pair_is_the_best_of_all():
    for sizes in itertools.combinations_with_replacement(range(1, 8), 5):
        for own in set(sizes):
            others = list(sizes)
            others.remove(own)
            for room in range(1, 15):
                sums = [a + b for a, b in itertools.combinations(others, 2) if a + b <= room]
                found = best_pair(Lengths({s: sizes.count(s) for s in sizes}), own, room)
                assert (sum(found) if found else None) == max(sums, default=None), (sizes, own, room)
