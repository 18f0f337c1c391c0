"""A passage of very many documents is dealt over all buckets, and answers are bounded by documents."""

import collections

import numpy as np
import pyarrow as pa
import pytest

from lyceum.llm.substring_dedup import ANCHOR, WINDOW, PLACE, Anchors, Windows, opened, received, repeated_windows, unpacked


@pytest.mark.parametrize("sender,dtype", [(Anchors, ANCHOR), (Windows, WINDOW)])
@pytest.mark.parametrize("kind", [pa.int64(), pa.string()])
def test_settled_places_are_spread(sender, dtype, kind):
    n, buckets = 20_000, 16
    docs = [(k if kind == pa.int64() else f"d{k}", 7) for k in range(n)]  # one text, so one tie
    entries = np.zeros(n, dtype)
    entries["hash"], entries["doc"], entries["at"] = 99, np.arange(n), 3
    one = sender(kind, dtype, buckets)
    one.add(docs, entries)
    load, places, batches = collections.Counter(), [], list(one.rows())
    for batch in batches:
        for bucket, own in zip(batch.column("bucket").to_pylist(), batch.column("docs").to_pylist(), strict=True):
            load[-1 - bucket if bucket < 0 else bucket] += len(own)
    assert max(load.values()) < 1.3 * n / buckets

    passed = received(batches, dtype)
    while True:
        try:
            batch = next(passed)
        except StopIteration as end:
            left, _ = end.value
            break
        for some, blob in opened(batch):
            part = unpacked(blob, PLACE)
            places += [(*some[d], at) for d, at in zip(part["doc"], part["at"], strict=True)]
    assert len(left) == 1  # one goes out, to meet those of other tasks
    settled = docs if sender is Anchors else docs[1:]
    assert sorted(places) == sorted((*d, 3) for d in settled)


@pytest.mark.parametrize("parts", [2, 12])
def test_answers_do_not_grow_with_the_partitions(spark, parts):
    """One row of places for each document, wherever its windows and the answers to them were."""
    draw = np.random.default_rng(4)
    passages = [" ".join(f"w{k}" for k in draw.integers(0, 5000, 25)) for _ in range(8)]
    rows = [(i, " ".join([f"own{i}", *draw.permutation(passages)[:4], f"end{i}"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = repeated_windows(docs).where("places is not null").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len({r.doc_id for r in found}) <= 300
    first_of = {}
    for i, text in rows:
        for passage in passages:
            if passage in text:
                first_of.setdefault(passage, i)
    assert {r.doc_id for r in found} >= {i for i, t in rows if any(p in t and first_of[p] != i for p in passages)}
