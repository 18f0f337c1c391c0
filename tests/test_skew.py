"""One key with a third of all rows: results equal the plain form, and rows spread."""

import random
from collections import defaultdict
from contextlib import contextmanager

import pytest
from helpers import ordered, tuples
from pyspark.sql import functions as F

from lyceum.operators import joins, sessions
from lyceum.operators.skew import hot_keys, skew_join


@contextmanager
def settings(spark):
    """Four shuffle tasks, no broadcast, no runtime changes: tasks show how keys were placed."""
    forced = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
              "spark.sql.shuffle.partitions": "4"}
    before = {key: spark.conf.get(key) for key in forced}
    for key, value in forced.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def skewed(frame, n=3000):
    rnd = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(200)}")) for i in range(n)]
    return frame(rows, "id int, k string")


def test_hot_keys_are_few(frame):
    assert tuples(hot_keys(skewed(frame), ["k"], share=0.1, slice_rows=100), "slices") == [(10,)]
    assert hot_keys(skewed(frame), ["k"], share=0.001, slice_rows=10).count() <= 1000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(frame, how):
    left = skewed(frame)
    right = frame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "k string, v int")
    salted = skew_join(left, right, ["k"], how, salted=True, share=0.05, slice_rows=150)
    assert tuples(salted, "id", "k", "v") == tuples(left.join(right, ["k"], how), "id", "k", "v")
    assert set(salted.columns) == {"id", "k", "v"}


def test_salted_join_spreads_the_hot_key(spark, frame):
    left = skewed(frame, 6000)
    right = frame([("hot", 1)], "k string, v int")
    with settings(spark):
        joined = skew_join(left, right, ["k"], "inner", salted=True, share=0.05, slice_rows=125)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) == 4 and max(per_task) < 0.6 * sum(per_task)


def test_rows_without_a_key_spread_too(spark, frame):
    left = frame([(i, None if i % 2 else "a") for i in range(4000)], "id int, k string")
    right = frame([("a", 1)], "k string, v int")
    with settings(spark):
        joined = skew_join(left, right, ["k"], "left", salted=True, share=0.05, slice_rows=125)
        missing = joined.where("v is null").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in missing) == 2000 and len(missing) == 4


@pytest.mark.parametrize("rows", [10**3, 10**9])
def test_join_is_the_same_plan_at_every_size(spark, rows):
    left = spark.range(rows).withColumnRenamed("id", "k")
    right = spark.range(rows).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    plans = [skew_join(left, right, ["k"], "left", salted)._jdf.queryExecution().optimizedPlan().toString()
             for salted in (False, True)]
    assert ["_slice" in plan for plan in plans] == [False, True]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_within_time_matches_all_pairs(frame, how):
    rows = _random_rows(8, 300)
    lhs = frame([*rows, (-1, None, 5, True, 0)], "id int, k string, s int, start boolean, v int").select(
        "id", "k", F.timestamp_seconds("s").alias("lt"))
    rhs = frame(_random_rows(9, 300), "id int, k string, s int, start boolean, v int").select(
        F.col("k").alias("rk"), F.timestamp_seconds("s").alias("rt"), F.col("id").alias("hit"))
    out = joins.join_feeds(lhs, rhs, "k", "rk", how, "lt", "rt", "10 seconds")
    close = (F.col("k") == F.col("rk")) & joins.near("lt", "rt", "10 seconds")
    assert tuples(out, "id", "hit") == tuples(lhs.join(rhs, close, how), "id", "hit")
    assert out.columns == ["id", "k", "lt", "rt", "hit"]


def test_outer_sides_that_salting_would_break_are_refused(frame):
    with pytest.raises(ValueError):
        skew_join(skewed(frame), skewed(frame), ["k"], "full")


def _random_rows(seed, n=1500):
    rnd = random.Random(seed)
    rows, clock = [], defaultdict(int)
    for i in range(n):
        key = "hot" if rnd.random() < 0.35 else f"k{rnd.randrange(30)}"
        clock[key] += rnd.choice([0, 1, 5, 10, 11, 12, 30])
        rows.append((i, key, clock[key], rnd.random() < 0.6, rnd.randrange(100)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_match_brute_force(frame, seed):
    rows = _random_rows(seed)
    expected, by_key = [], defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key[row[1]].append(row)
    for key, events in by_key.items():
        session = []
        for event in events:
            if session and event[2] - session[-1][2] > 11:
                expected.append((key, len(session), sum(e[4] for e in session), session[0][0], session[-1][0]))
                session = []
            session.append(event)
        expected.append((key, len(session), sum(e[4] for e in session), session[0][0], session[-1][0]))
    df = frame(rows, "id int, k string, s int, start boolean, v int").withColumn("ts", F.timestamp_seconds("s"))
    df = df.withColumn("first_id", F.col("id")).withColumn("last_id", F.col("id"))
    out = sessions.session_rollup(df, ["k"], 11, {"total": "v"}, ["first_id"], ["last_id"], "ts", ["id"])
    assert tuples(out, "k", "events", "total", "first_id", "last_id") == ordered(expected)


@pytest.mark.parametrize("seed,slice_seconds", [(1, 10), (2, 25), (3, 600)])
def test_bounces_match_brute_force(frame, seed, slice_seconds):
    rows = _random_rows(seed)
    by_key, expected = defaultdict(list), []
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key[row[1]].append(row)
    for events in by_key.values():
        for i, event in enumerate(events):
            following = events[i + 1] if i + 1 < len(events) else None
            if event[3] and (following is None or following[3] or following[2] - event[2] >= 10):
                expected.append((event[0],))
    df = frame(rows, "id int, k string, s int, start boolean, v int").withColumn("ts", F.timestamp_seconds("s"))
    out = sessions.bounces(df, "k", F.col("start"), 10, "ts", ["id"], slice_seconds)
    assert tuples(out, "id") == ordered(expected)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_within_matches_brute_force(frame, seed):
    left, right = _random_rows(seed, 600), _random_rows(seed + 10, 800)
    expected = []
    for row in left:
        hits = [(r[2], r[0]) for r in right if r[1] == row[1] and abs(r[2] - row[2]) <= 10]
        expected.append((row[0], max(hits)[1] if hits else None))
    schema = "id int, k string, s int, start boolean, v int"
    lhs = frame([*left, (-1, None, 5, True, 0)], schema).select("id", "k", F.timestamp_seconds("s").alias("lt"))
    rhs = frame([*right, (-2, None, 5, True, 0)], schema).select(
        F.col("k").alias("rk"), F.timestamp_seconds("s").alias("rt"), F.col("id").alias("hit"))
    out = joins.latest_within(lhs, rhs, "k", "rk", "lt", "rt", "10 seconds")
    assert tuples(out, "id", "hit") == ordered([*expected, (-1, None)])
    assert out.columns == ["id", "k", "lt", "rt", "hit"]
