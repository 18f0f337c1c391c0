"""Streams: equal to batch over several micro-batches, late rows, restarts."""

import datetime as dt
import random

import pytest
from helpers import ordered, tuples
from pyspark.sql import functions as F

from lyceum import schemas
from lyceum.functions.times import from_epoch_seconds
from lyceum.operators import firsts, joins, sessions, windows
from lyceum.plans import details, logs, summaries
from lyceum.session import scratch_path
from lyceum.sources import sinks
from lyceum.streaming import jobs, state

DAY0 = dt.datetime(2024, 1, 1)


def parts(spark, df, order, pieces, name):
    """The rows as a folder of ``pieces`` files in the given order, one per micro-batch."""
    path = scratch_path(spark, name)
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // pieces)
    for i in range(pieces):
        chunk = rows[i * size:(i + 1) * size]
        # Later files have later modification times, so they arrive in order.
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def events(frame):
    rnd = random.Random(3)
    rows, t = [], DAY0
    for i in range(400):
        t += dt.timedelta(minutes=rnd.choice([1, 5, 40, 300]))
        rows.append((i, t, f"u{rnd.randrange(6)}", rnd.choice(["view", "click"]), float(rnd.randrange(50))))
    return frame(rows, "id int, ts timestamp, user string, kind string, value double")


def closed(df, last, column="edt"):
    return df.where(F.to_timestamp(column) <= F.lit(last))


def test_first_of_day_window_equals_batch(spark, events):
    def counted(df):
        first = firsts.first_sightings(windows.watermark(df), ["user"]).withColumn("uv", F.lit(1).cast("long"))
        return windows.tumble_measures([first], [], ["uv"], "1 hour")

    stream = parts(spark, events, "ts", 4, "fd")
    out = jobs.materialise(counted(stream), "fd-out")
    last = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=5)
    assert tuples(out) == tuples(closed(counted(events), last)) and out.count() > 20


def test_first_rows_of_day_equal_batch(spark, events):
    stream = windows.watermark(parts(spark, events, "ts", 4, "fr"))
    out = jobs.materialise(firsts.first_rows_of_day(stream, ["user"]), "fr-out")
    assert tuples(out, "id") == tuples(firsts.first_rows_of_day(events, ["user"], "ts", ["id"]), "id")


def test_flags_equal_batch(spark, events):
    stream = parts(spark, events, "ts", 4, "flags")
    out = jobs.materialise(state.flag_days(stream, ["user"]), "flags-out")
    assert tuples(out, "id", "is_first") == tuples(
        firsts.flag_first_of_day(events, ["user"], ["id"]), "id", "is_first")
    assert out.where("is_new = 1").count() == events.select("user").distinct().count()


def test_silent_keys_can_be_forgotten(spark, events):
    """With a lifetime the state runs on processing time, so the query has to be stopped."""
    flagged = state.flag_days(parts(spark, events, "ts", 1, "ttl"), ["user"], ttl_ms=state.DAY_MS)
    path, checkpoint = scratch_path(spark, "ttl-out"), scratch_path(spark, "ttl-cp")
    query = sinks.to_files(flagged, path, checkpoint).trigger(processingTime="1 second").start()
    try:
        for _ in range(40):
            query.awaitTermination(1)
            if spark.read.schema(flagged.schema).parquet(path).count():
                break
    finally:
        query.stop()
    out = spark.read.schema(flagged.schema).parquet(path)
    assert tuples(out, "id", "is_first") == tuples(
        firsts.flag_first_of_day(events, ["user"], ["id"]), "id", "is_first")


def test_returning_users_equal_batch(spark, frame):
    rows = [(u, DAY0 + dt.timedelta(days=d)) for u, d in [("a", 0), ("a", 1), ("a", 9), ("a", 16), ("b", 3), ("b", 3), ("b", 30)]]
    df = frame(rows, "user string, ts timestamp")
    stream = parts(spark, df, "ts", 3, "back")
    out = jobs.materialise(state.returning_users(stream, "user"), "back-out")
    assert tuples(out) == tuples(firsts.returning_users(df, "user"))
    assert out.where("back_count = 1").count() == 2


def test_login_summary_from_a_detail_table(spark, frame):
    df = frame([("a", DAY0), ("a", DAY0 + dt.timedelta(days=8)), ("b", DAY0 + dt.timedelta(days=9))],
               "user_id string, ts timestamp")
    days = jobs.materialise(state.returning_users(parts(spark, df, "ts", 2, "lg"), "user_id"), "lg-days")
    again = parts(spark, days, "ts", 2, "lg2")
    out = jobs.materialise(summaries.dws_user_login_window(again), "lg-out")
    assert tuples(out, "back_count", "uv_count") == [(0, 1), (1, 1)]  # the last window is still open


def test_repair_equals_batch(spark, events):
    df = events.withColumn("is_new", F.when(F.col("kind") == "view", "1").otherwise("0"))
    stream = parts(spark, df, "ts", 4, "repair")
    out = jobs.materialise(state.repair_new_visitor(stream, "user"), "repair-out")
    assert tuples(out, "id", "is_new") == tuples(firsts.repair_new_visitor(df, "user", ties=["id"]), "id", "is_new")


def test_bounces_equal_batch_even_out_of_order(spark, frame):
    rnd = random.Random(9)
    rows, t = [], 0
    for i in range(300):
        t += rnd.choice([1, 4, 9, 10, 11])
        rows.append((i, f"m{rnd.randrange(4)}", t, t + rnd.choice([0, 0, 3]), rnd.random() < 0.6))
    df = frame(rows, "id int, mid string, s int, arrival int, start boolean").withColumn("ts", F.timestamp_seconds("s"))
    stream = windows.watermark(parts(spark, df, "arrival", 5, "bounce"), "ts", "10 seconds")
    out = jobs.materialise(state.bounces(stream, "mid", F.col("start")), "bounce-out")
    batch = sessions.bounces(df, "mid", F.col("start"), 10, "ts", ["id"])
    settled = batch.where(F.col("s") + 10 <= t - 10)
    assert set(tuples(settled, "id")) <= set(tuples(out, "id")) <= set(tuples(batch, "id"))
    assert out.count() > 50


def test_hold_keeps_the_newest_version_and_emits_once(spark, frame):
    rows = [("a", 0, 1), ("a", 1, 3), ("a", 1, 2), ("b", 2, 1), ("z", 60, 1), ("y", 66, 1), ("a", 67, 9), ("z", 200, 0)]
    df = frame(rows, "id string, s int, v int").withColumn("ts", F.timestamp_seconds("s")) \
        .withColumn("version", F.timestamp_seconds("v"))
    stream = windows.watermark(parts(spark, df, "s", 8, "hold"))
    out = jobs.materialise(state.hold_latest(stream, ["id"], "version", event_time=True, keep_ms=3_600_000), "hold-out")
    # a's version 9 comes after its hold: lost.  z is held until 65 s, y until 71 s.
    assert tuples(out, "id", "v") == [("a", 3), ("b", 1), ("y", 1), ("z", 1)]


def test_wall_clock_hold(spark, frame):
    df = frame([("a", 1), ("a", 2)], "id string, v int").withColumn("ts", F.timestamp_seconds("v"))
    held = state.hold_latest(parts(spark, df, "v", 1, "wall"), ["id"], "ts", hold_ms=500)
    path, checkpoint = scratch_path(spark, "wall-out"), scratch_path(spark, "wall-cp")
    query = sinks.to_files(held, path, checkpoint).trigger(processingTime="1 second").start()
    try:
        for _ in range(40):
            query.awaitTermination(1)
            if spark.read.schema(held.schema).parquet(path).count():
                break
    finally:
        query.stop()
    assert tuples(spark.read.schema(held.schema).parquet(path), "id", "v") == [("a", 2)]


def test_first_login_takes_the_earliest_row(spark, frame):
    rows = [("s", "u", 5, 0), ("s", "u", 3, 1), ("s", None, 1, 2), ("t", "w", 4, 3), ("s", "u", 60, 4), ("x", "w", 100, 5)]
    df = frame(rows, "sid string, uid string, t int, arrival int").withColumn("ts", F.timestamp_seconds("t"))
    stream = windows.watermark(parts(spark, df, "arrival", 3, "login"))
    out = jobs.materialise(state.first_login(stream, "sid", "uid"), "login-out")
    assert tuples(out, "sid", "t") == [("s", 3), ("t", 4)]


def test_sessions_equal_batch(spark, events):
    stream = windows.watermark(parts(spark, events, "ts", 4, "sess"))
    make = lambda df: sessions.session_rollup(df, ["user"], 3600, {"total": "value"}, ["kind"], ["id"], "ts", ["id"])
    out = jobs.materialise(make(stream), "sess-out")
    last = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=5)
    assert tuples(out) == tuples(make(events).where(F.col("session_end") <= F.lit(last)))


def change(table, seconds, data, kind="insert"):
    return ("edu", table, kind, data, str(1655049600 + seconds))


def test_order_detail_and_its_summary(spark, frame):
    rows = []
    for i in range(8):
        rows.append(change("order_info", 20 * i, {"id": f"o{i}", "province_id": "1", "session_id": f"s{i}"}))
        rows.append(change("order_detail", 20 * i + 2, {
            "id": f"d{i}", "order_id": f"o{i}", "user_id": f"u{i % 3}", "final_amount": "5",
            "create_time": "2022-06-12 16:00:00"}))
        rows.append(change("order_detail", 20 * i + 15, {"id": f"late{i}", "order_id": f"o{i}", "user_id": "x"}))
    changes = frame(rows, schemas.CHANGE_RECORD)
    page_rows = [({"sid": f"s{i}", "sc": str(i)}, {"page_id": "order"}, (1655049600 + 20 * i + 1) * 1000) for i in range(0, 8, 2)]
    pages = frame(page_rows, schemas.PAGE_LOG_MAPS)
    change_stream = parts(spark, changes, "ts", 4, "changes")
    page_stream = parts(spark, pages, "ts", 2, "pages")
    stamp = from_epoch_seconds("ts")
    streamed = details.dwd_trade_order_detail(change_stream, page_stream, row_op_ts=stamp)
    out = jobs.materialise(streamed, "orders-out")
    batch = details.dwd_trade_order_detail(changes, pages, "10 seconds", row_op_ts=stamp)
    matched = tuples(batch.where("source_id is not null"), "id", "source_id")
    assert tuples(out.where("source_id is not null"), "id", "source_id") == matched and len(matched) == 4
    # Lines without a page appear once the watermark rules a page out; the newest are still held.
    assert set(tuples(out, "id")) <= set(tuples(batch, "id")) and out.where("source_id is null").count() >= 2
    summary = summaries.dws_trade_order_window(jobs.table_as_stream(spark, _rewrite(spark, out), out))
    assert tuples(jobs.materialise(summary, "orders-sum")) == tuples(
        closed(summaries.dws_trade_order_window(out), _last(out)))


def _rewrite(spark, df):
    path = scratch_path(spark, "detail")
    df.write.parquet(path)
    return path


def _last(df):
    newest = df.agg(F.max(F.col("ts").cast("long"))).first()[0]
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=newest - 5)


def test_late_rows_are_dropped(spark, frame):
    df = frame([(0, 100, 1), (1, 200, 1), (2, 201, 1), (3, 101, 1), (4, 300, 1)], "n int, s int, v bigint").withColumn(
        "ts", F.timestamp_seconds("s"))
    stream = windows.watermark(parts(spark, df, "n", 5, "late"))
    out = jobs.materialise(windows.tumble(stream, [], windows.sums(["v"])), "late-out")
    # The row at 101 s arrives after the watermark passed 195 s.
    assert tuples(out, "v") == [(1,), (2,)]
    assert out.agg(F.sum("v")).first()[0] == 3


def test_restart_does_not_count_twice(spark, frame):
    path, target, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    schema = "s int, v bigint, ts timestamp"

    def run(rows):
        df = frame(rows, "s int, v bigint").withColumn("ts", F.timestamp_seconds("s"))
        df.coalesce(1).write.mode("append").parquet(path)
        stream = windows.watermark(spark.readStream.schema(schema).parquet(path))
        out = windows.tumble(stream, [], windows.sums(["v"]))
        sinks.run_available(sinks.to_files(out, target, checkpoint))
        return out.schema

    run([(1, 1), (2, 1), (30, 1)])
    kind = run([(31, 1), (60, 1)])
    run([])
    assert ordered(tuples(spark.read.schema(kind).parquet(target), "v")) == [(2,), (2,)]


def test_one_query_feeds_all_topics(spark, frame):
    rows = [{"common": {"mid": "a", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 1000},
            {"common": {"mid": "a", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 86_400_000 * 3},
            {"common": {"mid": "b", "is_new": "0"}, "appVideo": {"video_id": "1"}, "err": {"error_code": 1}, "ts": 2000}]
    df = frame(rows, schemas.BEHAVIOUR_LOG)
    out = jobs.materialise(jobs.base_log_records(parts(spark, df, "ts", 2, "base")), "base-out", ["topic"])
    assert sorted((r.topic, '"is_new":"0"' in r.value) for r in out.collect()) == [
        ("dwd_traffic_error_log", True), ("dwd_traffic_page_log", False),
        ("dwd_traffic_play_pre_process", True), ("dwd_traffic_start_log", True)]
    batch = logs.base_logs(df)
    assert {k: v.count() for k, v in batch.items()} == {
        "page": 1, "start": 1, "play": 1, "error": 1, "display": 0, "action": 0}


def test_unbounded_stream_join_is_refused_by_default_limit(spark, frame):
    left = windows.watermark(parts(spark, frame([("a", DAY0)], "k string, lt timestamp"), "k", 1, "jl"), "lt")
    right = windows.watermark(parts(spark, frame([("a", DAY0)], "rk string, rt timestamp"), "rk", 1, "jr"), "rt")
    joined = joins.join_feeds(left, right, "k", "rk", "inner", "lt", "rt", "10 seconds")
    assert joined.isStreaming and joined.columns == ["k", "lt", "rt"]


@pytest.fixture
def small_chunks(spark):
    """A key's rows reach a state processor ten at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    yield
    spark.conf.set(name, before)


def test_state_does_not_depend_on_chunks_or_order(spark, frame, small_chunks):
    """72 rows of one user in reverse order, in one micro-batch."""
    rows = [(i, DAY0 + dt.timedelta(hours=i), "u", "1") for i in reversed(range(72))]
    df = frame(rows, "id int, ts timestamp, user string, is_new string")
    flagged = jobs.materialise(state.flag_days(parts(spark, df, F.desc("ts"), 1, "chunks").drop("is_new"), ["user"]), "chunks-out")
    assert tuples(flagged.where("is_first = 1"), "id") == [(0,), (24,), (48,)]
    assert tuples(flagged.where("is_new = 1"), "id") == [(0,)]
    fixed = jobs.materialise(state.repair_new_visitor(parts(spark, df, F.desc("ts"), 1, "chunks-r"), "user"), "chunks-r-out")
    assert tuples(fixed.where("is_new = '1'"), "id") == [(i,) for i in range(24)]


def test_rows_without_a_time(spark, frame):
    df = frame([(1, DAY0, "u", "1"), (2, None, "u", "1"), (3, None, None, None)],
               "id int, ts timestamp, user string, is_new string")
    flagged = jobs.materialise(state.flag_days(parts(spark, df, "id", 1, "untimed").drop("is_new"), ["user"]), "untimed-out")
    assert tuples(flagged, "id", "is_first") == [(1, 1)]
    fixed = jobs.materialise(state.repair_new_visitor(parts(spark, df, "id", 1, "untimed-r"), "user"), "untimed-r-out")
    assert tuples(fixed, "id", "is_new") == [(1, "1"), (2, "1"), (3, None)]


def test_day_state_is_dropped_after_the_day(spark, frame):
    """400 users of one day each, over 40 days: the state holds those of the last days only."""
    rows = [(i, DAY0 + dt.timedelta(days=i // 10, minutes=i % 10), f"u{i}") for i in range(400)]
    df = frame(rows, "id int, ts timestamp, user string")
    stream = parts(spark, df, "ts", 8, "forget")
    first = firsts.first_sightings(windows.watermark(stream), ["user"])
    query = first.writeStream.format("parquet").option("path", scratch_path(spark, "forget-out")).option(
        "checkpointLocation", scratch_path(spark, "forget-cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    state_rows = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert max(state_rows) <= 150 and state_rows[-1] <= 80


def test_package_reaches_executors_from_any_folder(tmp_path):
    """A stream with keyed state, started elsewhere and with the package on the driver's path only."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from lyceum.session import build_session, prepare
spark = prepare(build_session("elsewhere", "local[2]", spark__ui__enabled="false",
    spark__sql__shuffle__partitions="1", spark__checkpoint__dir={str(tmp_path / "shared")!r}))
from lyceum.streaming import jobs, state
rows = spark.sql("select timestamp'2024-01-01 10:00:00' as ts, 'u' as user")
rows.write.parquet({str(tmp_path / "in")!r})
stream = spark.readStream.schema(rows.schema).parquet({str(tmp_path / "in")!r})
print("FOUND", jobs.materialise(state.flag_days(stream, ["user"]), "out").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "FOUND 1" in done.stdout, done.stderr[-2000:]
