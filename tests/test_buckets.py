"""Keyed state by buckets of keys: one call for many keys, results as if each key had its own."""

import random

import pandas as pd
import pyarrow as pa
import pytest
from helpers import tuples
from pyspark.sql import functions as F

from lyceum.streaming import state

DAY = state.DAY_MS


class Listed:
    def __init__(self):
        self.entries = []

    def exists(self):
        return bool(self.entries)

    def get(self):
        return iter(list(self.entries))

    def put(self, entries):
        self.entries = list(entries)

    def appendValue(self, entry):
        self.entries.append(entry)

    def clear(self):
        self.entries = []


class Handle:
    def __init__(self):
        self.lists, self.timers = {}, set()

    def getListState(self, name, *_):
        return self.lists.setdefault(name, Listed())

    def registerTimer(self, at):
        self.timers.add(at)


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentWatermarkInMs


def packed(rows, **types):
    """Rows as the chunks that a processor gets, several tables each."""
    frame = pd.DataFrame(rows)
    cut = [frame.iloc[i:i + 7] for i in range(0, len(frame), 7)]
    blobs = [state._to_bytes(pa.Table.from_pandas(c, preserve_index=False)) for c in cut]
    return iter([pd.DataFrame({"rows": blobs[i:i + 2]}) for i in range(0, len(blobs), 2)])


def given(frames):
    return [row for frame in frames for blob in frame["rows"] for row in state._from_bytes(blob).to_pylist()]


@pytest.mark.parametrize("keys", [1, 20])
def test_last_days_of_many_keys(keys):
    rnd = random.Random(keys)
    processor, handle, plain = state.FirstDays(3), Handle(), {}
    processor.init(handle)
    for batch in range(4):
        rows = []
        for i in range(200):
            t = rnd.randrange(batch * 4 * DAY, (batch * 4 + 6) * DAY)
            rows.append({"_key": f"k{rnd.randrange(keys)}", "_t": t, "_at": t * 1000, "_day": t // DAY, "id": i})
        wanted = []
        for row in sorted(rows, key=lambda r: r["_at"]):
            last = plain.get(row["_key"])
            if last is None or row["_day"] > last:
                plain[row["_key"]] = row["_day"]
                wanted.append((row["id"], int(last is None), int(last is not None and row["_day"] - last >= 3)))
        found = given(processor.handleInputRows((0,), packed(rows), At(0)))
        assert sorted((r["id"], r["is_new"], r["is_back"]) for r in found) == sorted(wanted)


@pytest.mark.parametrize("newest", [True, False])
def test_held_versions_of_many_keys(newest):
    """Against a plain loop: batches out of order within a lateness of 20, holds of 50, keys forgotten after 400."""
    rnd = random.Random(newest)
    processor, handle = state.HoldBests(newest, 50, 400), Handle()
    processor.init(handle)
    held, done, clock, found, wanted, ident = {}, {}, 0, [], [], 0
    for batch in range(80):
        mark = clock - 20
        rows = []
        for _ in range(rnd.randrange(1, 25)):
            clock += rnd.randrange(6)
            ident += 1
            rows.append({"_key": f"k{rnd.randrange(30)}", "_t": max(mark, clock - rnd.randrange(20)), "_rank": rnd.randrange(4), "id": ident})
        for key in {r["_key"] for r in rows} - set(held) - set(done):
            held[key] = (min(r["_t"] for r in rows if r["_key"] == key) + 50, None)
        for row in rows:
            if row["_key"] in held:
                until, best = held[row["_key"]]
                if row["_t"] <= until and (best is None or (
                        row["_rank"] >= best["_rank"] if newest else row["_rank"] < best["_rank"])):
                    held[row["_key"]] = (until, row)
        list(processor.handleInputRows((0,), packed(rows), At(mark)))
        mark = clock - 20
        for key in [k for k, at in done.items() if at <= mark]:
            del done[key]
        for key in [k for k, (until, _) in held.items() if until <= mark]:
            until, best = held.pop(key)
            wanted.append(best["id"])
            done[key] = until + 400
        while handle.timers and min(handle.timers) <= mark:
            due = min(handle.timers)
            handle.timers.remove(due)
            found += [r["id"] for r in given(processor.handleExpiredTimer((0,), At(mark), At(due)))]
        # What may be forgotten is forgotten with its part; here each key is asked for again at once.
        kept = {r["_key"] for t in state._listed(handle.lists["done"]) for r in t.to_pylist() if r["_forget"] > mark}
        assert kept == set(done)
        done = {r["_key"]: r["_forget"] for t in state._listed(handle.lists["done"]) for r in t.to_pylist()}
        assert len(handle.lists["done"].entries) <= state.HoldBests.PARTS + 1
    assert sorted(found) == sorted(wanted) and len(found) > 60


def test_packed_rows_are_thinned_and_come_back_whole(spark, frame):
    rows = [(i, ["hot", None, "b"][i % 3], i * 7200 % 400_000, {"a": str(i)}) for i in range(3000)] + [(-1, "hot", None, None)]
    df = frame(rows, "id int, k string, s int, m map<string,string>").withColumn("ts", F.timestamp_seconds("s"))
    all_rows = state._packed(df, ["k"], "ts")
    assert tuples(state._unpacked(all_rows, df.schema), "id") == [(i,) for i in range(3000)]
    assert state._unpacked(all_rows, df.schema).where("id = 77").first().m == {"a": "77"}
    thin = state._unpacked(state._packed(df, ["k"], "ts", thin=True, _day=F.unix_date(F.to_date("ts"))), df.schema)
    wanted = df.where("ts IS NOT NULL").groupBy("k", F.to_date("ts")).agg(F.min("ts")).count()
    assert wanted <= thin.count() <= wanted * df.rdd.getNumPartitions()
    assert state._packed(df, ["k"], "ts").count() <= 3 * df.rdd.getNumPartitions()


def test_bounces_of_many_visitors():
    """A bucket's visitors at once, against a plain loop; rows come out of order within a lateness of 300."""
    from test_stream_joins import One

    rnd, handle, settled = random.Random(3), Handle(), One()
    handle.getValueState = lambda *_: settled
    processor = state.BouncesOfBuckets(100)
    processor.init(handle)
    rows, found, calls, clock = [], [], 0, 0
    for batch in range(41):
        mark = clock - 300
        new = []
        for _ in range(120):
            clock += rnd.randrange(6)
            t = clock - rnd.randrange(299)
            new.append({"_key": f"k{rnd.randrange(12)}", "_t": t, "_start": rnd.random() < 0.5, "id": len(rows) + len(new)})
        if batch == 40:
            clock += 10_000
            new = [{"_key": "end", "_t": clock, "_start": False, "id": -1}]
        late = [{"_key": "k0", "_t": mark - 1, "_start": True, "id": -2}] if settled.exists() and settled.get()[0] >= mark - 1 else []
        rows += new
        list(processor.handleInputRows((0,), packed(new + late), At(mark)))
        calls += 1
        while handle.timers and min(handle.timers) <= clock - 300:
            due = min(handle.timers)
            handle.timers.remove(due)
            calls += 1
            found += [r["id"] for r in given(processor.handleExpiredTimer((0,), At(clock - 300), At(due)))]
    wanted = []
    for visitor in {r["_key"] for r in rows}:
        own = sorted((r for r in rows if r["_key"] == visitor), key=lambda r: (r["_t"], r["id"]))
        for row, after in zip(own, [*own[1:], None]):
            if row["_start"] and (after is None or after["_start"] or after["_t"] - row["_t"] >= 100):
                wanted.append(row["id"])
    assert sorted(found) == sorted(wanted) and len(found) > 1000 and calls < 500
    assert not handle.lists["held"].entries or len(state._listed(handle.lists["held"])) == 1
