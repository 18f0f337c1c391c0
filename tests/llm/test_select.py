"""Select in words, and neighbours that share a context."""

import numpy as np
import pytest

from lyceum.llm import elias_fano
from lyceum.llm.ngram_trie import Shape, Trie, mixed, quantised, shard_of


def test_nth_set():
    draw = np.random.default_rng(5)
    words = np.concatenate([draw.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2) + np.uint64(1),
                            np.uint64(1) << np.arange(64, dtype=np.uint64), [np.uint64(2**64 - 1)]])
    pairs = [(w, n, k) for w in words for n, k in enumerate(k for k in range(64) if int(w) >> k & 1)]
    found = elias_fano.nth_set(np.array([w for w, _, _ in pairs], np.uint64), np.array([n for _, n, _ in pairs]))
    assert found.tolist() == [k for _, _, k in pairs]


@pytest.mark.parametrize("shuffled", [False, True])
def test_a_context_is_asked_once(tmp_path, monkeypatch, shuffled):
    """Only the ``find`` of a trie is looked at: one shard of two contexts, 3 and 5, with ten followers each."""
    shape = Shape(str(tmp_path), 1, 0.75, [np.array([0, 40]), np.array([0, 20])], bits=6)
    trie, contexts = Trie(shape), np.array([3, 5])
    trie.store.write("level2-0", {
        **elias_fano.EliasFano.of(contexts, 40).arrays("contexts"),
        **elias_fano.EliasFano.of(np.array([0, 10, 20]), 21).arrays("pointers"),
        "followers": np.tile(np.arange(0, 20, 2), 2).astype(np.uint32)})
    trie.store.write("codes2-0", {"codes": quantised(-np.arange(20) / 8)})
    context, token = np.repeat([2, 3, 4, 5, 6], 21), np.tile(np.arange(21), 5)
    if shuffled:
        order = np.random.default_rng(1).permutation(len(context))
        context, token = context[order], token[order]
    asked = []
    plainly = elias_fano.EliasFano.find
    monkeypatch.setattr(elias_fano.EliasFano, "find", lambda self, values: asked.append(len(values)) or plainly(self, values))
    assert not shard_of(mixed(trie.keys(context, token), 2), 1).any()
    nodes, logs = trie.find(2, context, token)
    there = np.isin(context, contexts) & (token < 20) & (token % 2 == 0)
    expected = np.where(there, (context == 5) * 10 + token // 2, -1)
    assert nodes.tolist() == expected.tolist() and np.allclose(logs, np.where(there, -expected / 8, 0))
    assert shuffled or asked == [5]
