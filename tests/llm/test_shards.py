"""What a task of the n-gram model holds: one shard, packed in pieces, of no more tokens than is set."""

import tracemalloc

import numpy as np
import plain
import pyarrow as pa
from pyspark.sql import functions as F

from lyceum.llm import elias_fano, ngram_trie


def test_a_task_gets_one_shard(spark):
    def count(batches):
        yield pa.record_batch({"n": [len({x for b in batches for x in b["shard"].to_pylist()})]})

    rows = spark.range(400).select((F.col("id") % 40).cast("int").alias("shard"))
    assert {r.n for r in ngram_trie.exchanged(rows, 40).mapInArrow(count, "n long").collect()} == {1}


def test_packing_takes_little_more_than_its_result():
    values = np.random.default_rng(2).integers(0, 1 << 14, 1_000_003, dtype=np.uint64)
    tracemalloc.start()
    words = elias_fano.packed(values, 14)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 << 20
    at = np.array([0, 1, 65_535, 65_536, 65_537, 999_999, 1_000_002])
    assert (elias_fano.unpacked(words, 14, at) == values[at]).all()


def test_rows_of_a_shard_are_summed_whole():
    rnd = np.random.default_rng(3)
    keys = [np.unique(rnd.integers(0, 1 << 60, 5000, dtype=np.uint64) % np.uint64(9000)) for _ in range(7)]
    batches = [b for k in keys for b in ngram_trie.sent(k, np.full(len(k), 2, np.uint64), (k % np.uint64(3)).astype(np.int64), 3)]
    found = {s: dict(zip(k.tolist(), c.tolist())) for s, k, c in ngram_trie.by_shard(iter(batches), "<u8")}
    every, times = np.unique(np.concatenate(keys), return_counts=True)
    assert found == {s: {k: 2 * n for k, n in zip(every.tolist(), times.tolist()) if k % 3 == s} for s in range(3)}


def test_shards_grow_with_the_tokens(spark, monkeypatch):
    rows = spark.createDataFrame([(i, t) for i, t in plain.corpus() if i is not None], "doc_id long, text string")
    few = ngram_trie.build(spark, rows, shards=2)
    wanted = sorted((r.doc_id, r.score) for r in ngram_trie.score(rows, few).collect())
    monkeypatch.setattr(ngram_trie, "PER_SHARD", -(-few.tokens // 9))
    monkeypatch.setattr(ngram_trie, "AT_ONCE", 50)  # and the followers of a context are parted
    many = ngram_trie.build(spark, rows, shards=2)
    assert [len(b) - 1 for b in few.bases] == [2, 2, 2] and [len(b) - 1 for b in many.bases] == [2, 9, 9]
    assert [b[-1] for b in few.bases] == [b[-1] for b in many.bases]
    found = sorted((r.doc_id, r.score) for r in ngram_trie.score(rows, many).collect())
    assert [i for i, _ in found] == [i for i, _ in wanted]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(found, wanted))
