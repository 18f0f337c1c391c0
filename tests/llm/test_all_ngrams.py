"""The registered query scores with every n-gram of the training texts, also those counted once."""

import collections
import math
import zlib

import plain

from lyceum.llm.queries import QUERIES


def whole_model(train, order=3, discount=0.75):
    counts = [collections.Counter() for _ in range(order)]
    for own in train:
        for k in range(order):
            counts[k].update(tuple(own[i:i + k + 1]) for i in range(len(own) - k))
    total, distinct = sum(counts[0].values()), len(counts[0])
    followers = collections.Counter(g[:-1] for level in counts[1:] for g in level.keys())
    behind = collections.Counter()
    for level in counts[1:]:
        for g, c in level.items():
            behind[g[:-1]] += c

    def p(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 1) / (total + distinct + 1)
        n = counts[len(gram) - 2][gram[:-1]]
        if not n:
            return p(gram[1:])
        left = 1 - (behind[gram[:-1]] - discount * followers[gram[:-1]]) / n
        return max(counts[len(gram) - 1][gram] - discount, 0) / n + left * p(gram[1:])

    return lambda own: sum(math.log10(p(tuple(own[max(0, i - order + 1):i + 1]))) for i in range(len(own)))


def test_query_keeps_ngrams_counted_once(spark, tmp_path):
    rows = list({i: (i, t) for i, t in plain.corpus() if i is not None}.values())
    rows += [(1000 + k, f"once{k} only{k} here{k} in the fold") for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {i: [*plain.words(plain.lower(t)), "\n"] for i, t in rows}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    score = whole_model([own for i, own in tokens.items() if i not in held])
    found = QUERIES["op8_ngram_trie"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and {r.doc_id for r in found if r.held_out} == held
    for r in found:
        assert abs(r.score - score(tokens[r.doc_id])) < 1e-3 * r.n_tokens
