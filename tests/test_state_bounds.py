"""Keyed state with a hot key: what is kept is bounded by days or visitors, not by rows."""

import random

import numpy as np
import pandas as pd
import pytest
from helpers import tuples
from pyspark.sql import functions as F

from lyceum.streaming import state

DAY = state.DAY_MS


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Chunks:
    """A map state that remembers the largest entry."""

    def __init__(self):
        self.entries, self.largest = {}, 0

    def updateValue(self, key, value):
        self.entries[key] = value
        self.largest = max(self.largest, len(value[0]))

    def getValue(self, key):
        return self.entries[key]

    def removeKey(self, key):
        del self.entries[key]


class Handle:
    def __init__(self):
        self.value, self.chunks, self.timers = Value(), Chunks(), set()

    def getValueState(self, *_):
        return self.value

    def getMapState(self, *_):
        return self.chunks

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


def started(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def rows_of(n, seed, span=20 * DAY):
    rnd = random.Random(seed)
    t = [rnd.randrange(span) for _ in range(n)]
    return pd.DataFrame({"t": t, "day": [x // DAY for x in t], "payload": [f"r{i}" for i in range(n)],
                         "claims": [rnd.randrange(2) for _ in range(n)]})


def cut(frame, size):
    return (frame.iloc[i:i + size] for i in range(0, len(frame), size))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_first_of_each_day_however_rows_are_cut(size):
    frame = rows_of(500, size)
    processor = state.LastDay(8, None)
    started(processor)
    out = pd.concat(processor.handleInputRows(("k",), cut(frame, size), None))
    firsts = frame.sort_values("t", kind="stable").drop_duplicates("day")["payload"]
    assert sorted(out["payload"]) == sorted(frame["payload"])
    assert sorted(out[out["is_first"] == 1]["payload"]) == sorted(firsts)
    assert out["is_new"].sum() == 1


def test_only_first_rows_leave_and_days_are_remembered():
    frame = rows_of(5000, 1)
    processor = state.LastDay(3, None, only_first=True)
    started(processor)
    out = pd.concat(processor.handleInputRows(("k",), cut(frame, 50), None))
    assert len(out) == frame["day"].nunique()
    again = pd.DataFrame({"t": [25 * DAY, 19 * DAY], "day": [25, 19], "payload": ["a", "b"]})
    later = pd.concat(processor.handleInputRows(("k",), iter([again]), None))
    assert later[["payload", "is_first", "is_new", "is_back"]].values.tolist() == [["a", 1, 0, 1]]
    assert list(processor.handleInputRows(("k",), iter([again]), None)) == []


@pytest.mark.parametrize("size", [1, 9, 1000])
def test_claims_of_a_new_visitor_wait_in_the_state_store(size):
    frame = rows_of(400, size + 50)
    processor = state.FirstDate()
    handle = started(processor)
    out = pd.concat(processor.handleInputRows(("k",), cut(frame, size), None))
    first = frame.sort_values(["t", "claims"], kind="stable").iloc[0]
    day = first["day"] if first["claims"] else first["day"] - 1
    wrong = frame[(frame["claims"] == 1) & (frame["day"] != day)]["payload"]
    assert sorted(out["payload"]) == sorted(frame["payload"])
    assert sorted(out[out["wrong"] == 1]["payload"]) == sorted(wrong)
    assert handle.chunks.largest <= size and not handle.chunks.entries
    known = rows_of(50, 3)
    more = pd.concat(processor.handleInputRows(("k",), cut(known, size), None))
    assert more["wrong"].sum() == ((known["claims"] == 1) & (known["day"] != day)).sum()


def plain_bounces(rows, within):
    rows = sorted(rows, key=lambda r: r[0])
    return sorted(p for i, (t, start, p) in enumerate(rows) if start and (
        i + 1 == len(rows) or rows[i + 1][1] or rows[i + 1][0] - t >= within))


@pytest.mark.parametrize("delay", [0, 30, 500])
def test_bounces_of_rows_out_of_order(delay):
    rnd = random.Random(delay)
    processor = state.Bounces(100)
    handle = started(processor)
    rows, found, clock, longest = [], [], 0, 0
    for batch in range(60):
        new = []
        for i in range(rnd.randrange(1, 12)):
            clock += rnd.choice([1, 20, 60, 100, 140])
            # Distinct times, so that the plain order is the only one.
            new.append(((clock - rnd.randrange(delay + 1)) * 1000 + batch * 12 + i, rnd.random() < 0.5, f"{batch}-{i}"))
        mark = max([r[0] for r in rows], default=-1) - delay * 1000
        new = [r for r in new if r[0] > mark]
        if not new:
            continue
        rows += new
        frame = pd.DataFrame(new, columns=["t", "starts", "payload"])
        processor.within_ms = 100_000
        list(processor.handleInputRows(("v",), cut(frame, 4), None))
        assert len(handle.timers) == 1
        mark = max(r[0] for r in rows) - delay * 1000
        while handle.timers and min(handle.timers) <= mark:
            due = min(handle.timers)
            handle.timers.remove(due)
            for out in processor.handleExpiredTimer(("v",), At(mark), At(due)):
                found += out["payload"].tolist()
            assert len(handle.timers) <= 1
            ahead = sum(t > mark for t, _, _ in rows)
            assert not handle.value.exists() or len(handle.value.get()[0]) <= ahead + 1
    for due in list(handle.timers):
        handle.timers.remove(due)
        for out in processor.handleExpiredTimer(("v",), At(10**12), At(due)):
            found += out["payload"].tolist()
    assert sorted(found) == plain_bounces(rows, 100_000)
    assert not handle.value.exists() and not handle.timers


def test_rows_are_thinned_before_the_shuffle(spark, frame):
    rows = [(i, ["hot", None, "b"][i % 3], i * 7200 % 400_000) for i in range(3000)] + [(-1, "hot", None)]
    df = frame(rows, "id int, k string, s int").withColumn("ts", F.timestamp_seconds("s"))
    thin = state.thin_days(df, ["k"], "ts")
    assert thin.schema == df.schema
    best = {}
    for row in thin.collect():
        day = (row.k, row.ts.date())
        best[day] = min(best.get(day, row.ts), row.ts)
    day = F.to_date("ts").alias("day")
    wanted = df.where("ts IS NOT NULL").groupBy("k", day).agg(F.min("ts").alias("ts"))
    assert best == {(r.k, r.day): r.ts for r in wanted.collect()}
    assert thin.count() <= len(best) * df.rdd.getNumPartitions()
    assert tuples(state.thin_days(df.where("false"), ["k"], "ts")) == []


def test_the_watermark_stays_on_the_time(spark, frame):
    df = frame([("a", 1)], "k string, s int").withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "5 seconds")
    kept = state.thin_days(df, ["k"], "ts").schema["ts"].metadata
    assert kept == df.schema["ts"].metadata


def test_arrays_of_an_empty_state():
    processor = state.Bounces(10)
    started(processor)
    assert [len(part) for part in processor._held()[:3]] == [0, 0, 0]
    assert np.array(processor._held()[0]).dtype == np.int64
