"""Stream joins by buckets of keys: the pairs of a plain loop, few calls of the state store, state that ends."""

import random

import pandas as pd
import pyarrow as pa
import pytest
from helpers import tuples
from pyspark.sql import functions as F
from test_buckets import At, given

from lyceum.operators.windows import watermark
from lyceum.queries import live, streams
from lyceum.streaming import jobs, joins, state

DAY = state.DAY_MS


class Kept:
    def __init__(self):
        self.entries, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.entries[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def removeKey(self, key):
        del self.entries[key]


class One:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.kept, self.index, self.timers = Kept(), One(), set()

    def getMapState(self, *_):
        return self.kept

    def getValueState(self, *_):
        return self.index

    def registerTimer(self, at):
        self.timers.add(at)


def blobs(rows, side):
    types = pa.schema([("k" if side == 0 else "rk", pa.string()), ("lt" if side == 0 else "rt", pa.timestamp("us", "UTC")),
                       ("n" if side == 0 else "v", pa.int64())])
    return [(side, state._to_bytes(pa.Table.from_pylist(rows[i:i + 40], types))) for i in range(0, len(rows), 40)]


@pytest.mark.parametrize("keys, within", [(1, DAY // 50), (40, DAY // 5), (5, 3 * DAY)])
def test_pairs_are_those_of_a_plain_loop(monkeypatch, keys, within):
    monkeypatch.setattr(joins, "PART_ROWS", 100)
    rnd, handle = random.Random(keys), Handle()
    processor = joins.WithinJoin(("k", "rk"), ("lt", "rt"), within, (within, within), "seen")
    processor.init(handle)
    left, right, found, ident = [], [], [], 0
    for batch in range(12):
        mark, new = batch * DAY, ([], [])
        for _ in range(150):
            t, ident = rnd.randrange(mark, mark + 2 * DAY) * 1000, ident + 1
            if rnd.random() < 0.6:
                new[0].append({"k": f"k{rnd.randrange(keys)}", "lt": t, "n": ident})
            else:
                new[1].append({"rk": f"k{rnd.randrange(keys)}", "rt": t, "v": ident})
        left, right = left + new[0], right + new[1]
        came = blobs(new[0], 0) + blobs(new[1], 1)
        rnd.shuffle(came)
        chunks = [pd.DataFrame(came[i:i + 3], columns=["side", "rows"]) for i in range(0, len(came), 3)]
        out = list(processor.handleInputRows((0,), iter(chunks), At(mark)))
        assert all(f["seen"][0].value // 10**6 >= mark for f in out)
        found += given(out)
        for due in [t for t in handle.timers if t <= mark]:
            handle.timers.remove(due)
            list(processor.handleExpiredTimer((0,), At(mark), At(due)))
        # What is kept ends with its slice.
        assert min(piece for _, piece, _ in handle.kept.entries) * processor.width // 1000 >= mark - 2 * processor.width // 1000
    wanted = [(a["n"], b["v"]) for a in left for b in right if a["k"] == b["rk"] and abs(a["lt"] - b["rt"]) <= within * 1000]
    assert sorted((r["n"], r["v"]) for r in found) == sorted(wanted) and len(wanted) > 100
    assert handle.kept.calls < ident / 5
    handle.timers.add(100 * DAY)
    list(processor.handleExpiredTimer((0,), At(100 * DAY), At(100 * DAY)))
    assert not handle.kept.entries and not handle.index.exists()


def test_many_parts_become_one():
    processor, handle = joins.WithinJoin(("k", "rk"), ("lt", "rt"), DAY, (DAY, DAY)), Handle()
    processor.init(handle)
    for n in range(processor.PARTS + 5):
        row = [{"k": "a", "lt": n, "n": n}]
        list(processor.handleInputRows((0,), iter([pd.DataFrame(blobs(row, 0), columns=["side", "rows"])]), At(0)))
    for n in range(2):
        chunk = pd.DataFrame(blobs([{"rk": "a", "rt": 7, "v": n}], 1), columns=["side", "rows"])
        out = given(processor.handleInputRows((0,), iter([chunk]), At(0)))
        assert [r["n"] for r in out] == list(range(processor.PARTS + 5)) and {r["v"] for r in out} == {n}
        assert sum(side == 0 for side, _, _ in handle.kept.entries) == 1


def test_partners_meet_across_pieces(spark, frame):
    left = frame([(f"k{i % 7}", i, i) for i in range(400)] + [(None, -1, 5)], "k string, n int, s int")
    right = frame([(f"k{i % 7}", i, i * 2) for i in range(200)] + [(None, -1, 5)], "rk string, v int, rs int")
    left, right = left.withColumn("lt", F.timestamp_seconds("s")), right.withColumn("rt", F.timestamp_seconds("rs"))
    made = []

    def run(feed):
        pairs = joins.join_within(watermark(feed["left"], "lt"), watermark(feed["right"], "rt"), "k", "rk", "lt", "rt", 30)
        assert pairs.columns == ["k", "n", "s", "lt", "v", "rs", "rt"]
        made.append(jobs.append(pairs, made[0] if made else f"{spark.conf.get('spark.checkpoint.dir')}/pairs"))
        made[0] = f"{spark.conf.get('spark.checkpoint.dir')}/pairs"

    pieces = [{"left": left.where(F.col("s").between(a, a + 99)), "right": right.where(F.col("rs").between(a, a + 99))} for a in (0, 100, 200, 300)]
    jobs.replay_feeds(spark, pieces, run, "pairs")
    wanted = left.join(right, (left.k == right.rk) & (F.abs(left.s - right.rs) <= 30)).select("n", "v")
    assert tuples(spark.read.parquet(made[0]), "n", "v") == tuples(wanted) and wanted.count() > 1000


@pytest.mark.parametrize("make", [streams.stream_order_lines, live.stream_pay_suc_detail, live.stream_order_detail])
def test_streams_use_no_join_by_rows(spark, monkeypatch, make):
    plans = []

    class Planned(Exception):
        pass

    def planned(stream, *_):
        plans.append(stream._jdf.queryExecution().analyzed().toString())
        raise Planned

    monkeypatch.setattr(jobs, "materialise", planned)
    monkeypatch.setattr(jobs, "for_each_batch", planned)
    with pytest.raises(Planned):
        make(spark, "/root/testdata/sf0.001")
    assert "TransformWithState" in plans[0] and "Join" not in plans[0]
