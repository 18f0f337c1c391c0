"""Operators on hand-made rows: nulls, ties, duplicates, boundaries."""

import datetime as dt

import pytest
from helpers import ordered, tuples
from pyspark.sql import functions as F

from lyceum import schemas
from lyceum.functions import keywords, times, values
from lyceum.operators import cleaning, firsts, joins, latest, lookup, routing, sessions, windows


def at(seconds):
    return dt.datetime(2022, 6, 13) + dt.timedelta(seconds=seconds)


# --- cleaning ------------------------------------------------------------------------------------
def test_malformed_and_null_text_is_dirty_and_tombstones_vanish(frame):
    feed = frame([('{"common":{"mid":"1"},"ts":5}',), ("{bad",), ("null",), (None,), ("",)], "value string")
    clean, dirty = cleaning.clean_logs(feed, schemas.BEHAVIOUR_LOG)
    assert tuples(clean, "common.mid", "ts") == [("1", 5)]
    assert tuples(dirty) == [("",), ("null",), ("{bad",)]


def test_changes_without_type_are_dirty_and_markers_dropped(frame):
    feed = frame([
        ('{"table":"a","type":"insert","data":{"id":"1"},"ts":"3"}',), ('{"table":"a","data":{"id":"2"}}',),
        ('{"table":"a","type":"bootstrap-start"}',), ('{"table":"a","type":"bootstrap-complete"}',), ("x",),
        ('{"table":"a","type":"bootstrap-insert","data":{"id":"9 = \'ha\'"}}',),
    ], "value string")
    clean, dirty = cleaning.clean_changes(feed, schemas.CHANGE_RECORD)
    assert tuples(clean.select(F.col("data")["id"])) == [("1",), ("9 = 'ha'",)]
    assert dirty.count() == 2


# --- routing -------------------------------------------------------------------------------------
LOGS = [
    '{"common":{"mid":"1"},"start":{"entry":"icon"},"err":{"error_code":7},"ts":1}',
    '{"common":{"mid":"2"},"appVideo":{"video_id":"v","play_sec":3},"page":{"page_id":"p"},"ts":2}',
    '{"common":{"mid":"3"},"page":{"page_id":"home"},"displays":[{"item":"a"},{"item":"b"}],'
    '"actions":[{"action_id":"x"}],"err":{"error_code":8},"ts":3}',
    '{"common":{"mid":"4"},"page":{"page_id":"home"},"displays":[],"ts":4}',
]


def test_each_record_takes_one_route_plus_errors(frame):
    logs, _ = cleaning.clean_logs(frame([(t,) for t in LOGS], "value string"), schemas.BEHAVIOUR_LOG)
    out = routing.split_logs(logs)
    mids = {kind: [r.mid for r in df.select("common.mid").orderBy("mid").collect()] for kind, df in out.items()}
    assert mids == {"page": ["3", "4"], "start": ["1"], "play": ["2"], "error": ["1", "3"],
                    "display": ["3", "3"], "action": ["3"]}
    assert "ts" not in out["action"].columns and "err" not in out["start"].columns
    assert set(out["page"].columns) == {"common", "start", "page", "appVideo", "ts"}
    assert out["error"].where("displays is not null").count() == 1


def test_topic_records_hold_the_same_rows_in_one_pass(frame):
    logs, _ = cleaning.clean_logs(frame([(t,) for t in LOGS], "value string"), schemas.BEHAVIOUR_LOG)
    records = routing.as_topic_records(logs)
    counts = {r.topic: r["count"] for r in records.groupBy("topic").count().collect()}
    split = {routing.TOPICS[k]: df.count() for k, df in routing.split_logs(logs).items()}
    assert counts == split
    actions = records.where(F.col("topic") == routing.TOPICS["action"]).collect()
    assert actions[0].value == '{"action":{"action_id":"x"},"common":{"mid":"3"},"page":{"page_id":"home"}}'


# --- keyed ---------------------------------------------------------------------------------------
def test_latest_version_wins_and_null_keys_are_a_group(frame):
    rows = frame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w"), (None, 1, "n"), (None, 3, "m")],
                 "id string, v int, d string")
    assert tuples(latest.latest_per_key(rows, "id", ["v", "d"])) == [(None, 3, "m"), ("a", 2, "z"), ("b", None, "w")]


def test_first_of_day_changes_at_midnight(frame):
    rows = frame([(1, "u", at(-1)), (2, "u", at(0)), (3, "u", at(86399)), (4, "u", at(86400)), (5, "w", at(5)),
                  (6, "w", at(5))], "id int, user string, ts timestamp")
    flagged = firsts.flag_first_of_day(rows, ["user"], ["id"])
    assert tuples(flagged, "id", "is_first") == [(1, 1), (2, 1), (3, 0), (4, 1), (5, 1), (6, 0)]
    assert tuples(firsts.first_sightings(rows, ["user"]), "user", "ts") == [
        ("u", at(-1)), ("u", at(0)), ("u", at(86400)), ("w", at(5))]
    assert tuples(firsts.first_ever(rows, ["user"]), "user", "ts") == [("u", at(-1)), ("w", at(5))]
    assert tuples(firsts.first_rows_of_day(rows, ["user"], "ts", ["id"]), "id") == [(1,), (2,), (4,), (5,)]


def test_days_follow_the_session_time_zone(spark, frame):
    rows = frame([(1, 1655049600000 - 1), (2, 1655049600000)], "id int, ms bigint")
    spark.conf.set("spark.sql.session.timeZone", "GMT+8")
    try:
        days = rows.select("id", times.date_text(times.from_epoch_millis("ms")).alias("day"))
        assert tuples(days) == [(1, "2022-06-12"), (2, "2022-06-13")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("last,current,back", [
    ("2022-02-01", "2022-02-22", 1), ("2022-02-01", "2022-02-09", 1), ("2022-02-01", "2022-02-08", 0)])
def test_returning_users(frame, last, current, back):
    rows = frame([("u", f"{last} 23:00:00"), ("u", f"{current} 01:00:00"), ("u", f"{current} 02:00:00")],
                 "user string, t string").withColumn("ts", F.to_timestamp("t"))
    out = firsts.returning_users(rows, "user")
    assert [tuple(r) for r in out.orderBy("ts").select("uv_count", "back_count").collect()] == [(1, 0), (1, back)]


REPAIR = [
    ("a", "1", 0, "1"), ("a", "1", 60, "1"), ("a", "1", 86400, "0"), ("a", "0", 90000, "0"),
    ("b", "0", 0, "0"), ("b", "1", 60, "0"), ("b", "1", -86400 * 2, "1"),
    ("c", None, 0, None), ("c", "1", 5, "0"),
]


@pytest.mark.parametrize("options", [{}, {"salted": True, "slice_rows": 1, "share": 0.1}])
def test_new_visitor_repair(frame, options):
    rows = frame([(i, mid, flag, at(s)) for i, (mid, flag, s, _) in enumerate(REPAIR)],
                 "id int, mid string, is_new string, ts timestamp")
    fixed = firsts.repair_new_visitor(rows, ties=["id"], **options)
    expected = [(i, want) for i, (_, _, _, want) in enumerate(REPAIR)]
    # b: its first row by time is the claim two days before.
    assert tuples(fixed, "id", "is_new") == ordered(expected)


# --- sessions ------------------------------------------------------------------------------------
def test_play_sessions_merge_at_exactly_the_gap(frame):
    rows = frame([("s", at(0), 5, 10), ("s", at(11), 5, 20), ("s", at(22.5), 5, 30), ("s", at(22), 7, 25),
                  ("s", at(34), 1, 99), ("t", at(0), 1, 1)],
                 "sid string, ts timestamp, play int, pos int")
    out = sessions.session_rollup(rows, ["sid"], 11, {"play": "play"}, [], ["pos"])
    # 22.5 -> 34 is 11.5 s: a new session.
    assert tuples(out, "sid", "events", "play", "pos") == [("s", 1, 1, 99), ("s", 4, 22, 30), ("t", 1, 1, 1)]


def test_bounce_fixture(frame):
    rows = frame([("101", None, 10), ("102", None, 12), ("102", "home", 15), ("102", "detail", 30)],
                 "mid string, last string, s int").withColumn("ts", F.timestamp_seconds("s"))
    out = sessions.bounces(rows, "mid", F.col("last").isNull())
    # The last row of 102 is no start; its first one is followed by a page of the same visit.
    assert tuples(out, "mid", "s") == [("101", 10)]
    assert set(out.columns) == set(rows.columns)


@pytest.mark.parametrize("next_at,next_last,bounced", [
    (9, None, True), (9, "home", False), (10, "home", True), (59, "home", True), (61, None, True)])
def test_bounce_boundaries_across_slices(frame, next_at, next_last, bounced):
    rows = frame([("m", None, 55), ("m", next_last, 55 + next_at)], "mid string, last string, s int")
    rows = rows.withColumn("ts", F.timestamp_seconds("s"))
    out = sessions.bounces(rows, "mid", F.col("last").isNull(), 10, slice_seconds=10)
    assert (("m", 55) in tuples(out, "mid", "s")) == bounced


def test_first_login_ignores_anonymous_rows(frame):
    rows = frame([("s", None, 1), ("s", "u", 3), ("s", "u", 2), ("t", None, 1)], "sid string, uid string, ts int")
    assert tuples(sessions.first_login(rows, "sid", "uid")) == [("s", "u", 2)]


# --- joins and lookups -----------------------------------------------------------------------------
def test_join_within_time(frame):
    left = frame([("a", at(0)), ("b", at(0)), ("c", at(0))], "k string, lt timestamp")
    right = frame([("a", at(10)), ("b", at(11)), ("a", at(-10))], "rk string, rt timestamp")
    inner = joins.join_feeds(left, right, "k", "rk", "inner", "lt", "rt", "10 seconds")
    assert tuples(inner, "k") == [("a",), ("a",)]
    outer = joins.join_feeds(left, right, "k", "rk", "left", "lt", "rt", "10 seconds")
    assert tuples(outer.select("k", F.col("rt").isNull())) == [("a", False), ("a", False), ("b", True), ("c", True)]


def test_lookup_leaves_nulls_and_takes_several_keys(frame):
    facts = frame([("1", "x", 5), ("2", "x", 6), (None, "x", 7)], "id string, kind string, n int")
    dim = frame([("1", "x", "one"), ("2", "y", "two")], "id string, kind string, name string")
    out = lookup.lookup(facts, dim, {"id": "id", "kind": "kind"}, {"name": "label"})
    assert tuples(out, "n", "label") == [(5, "one"), (6, None), (7, None)]


def test_config_fold_and_column_choice(frame):
    row = lambda t, cols: (t, f"dim_{t}", cols, None, None)
    changes = frame([
        ("r", None, row("a", "id,name"), 1), ("u", None, row("a", "course_id, name"), 2), (None, None, row("a", "x"), 3),
        ("c", None, row("b", "id"), 1), ("d", row("b", "id"), None, 2), ("d", row("c", "id"), None, 1),
        ("c", None, row("c", "id"), 2)], schemas.CONFIG_CHANGE)
    config = lookup.fold_config(changes, ["ts_ms"])
    assert tuples(config, "source_table", "sink_columns") == [("a", "course_id, name"), ("c", "id")]
    records = frame([("a", "insert", {"id": "1", "course_id": "2", "name": "n"}, "1"), ("a", None, {"id": "1"}, "1"),
                     ("zzz", "insert", {"id": "1"}, "1")], "table string, type string, data map<string,string>, ts string")
    routed = lookup.dimension_changes(records, config)
    # ``id`` is not listed, although it is part of ``course_id``.
    assert [r.data for r in routed.collect()] == [{"course_id": "2", "name": "n"}]
    assert [r.sink_pk for r in routed.collect()] == ["id"]


# --- windows, functions ------------------------------------------------------------------------------
def test_tumbling_bounds_and_missing_measures(frame):
    rows = frame([("k", at(9.999), 1), ("k", at(10), 2)], "k string, ts timestamp, a bigint")
    other = frame([("k", at(3), 5)], "k string, ts timestamp, b bigint")
    out = windows.tumble_measures([rows, other], ["k"], ["a", "b"])
    assert tuples(out) == [("2022-06-13 00:00:00", "2022-06-13 00:00:10", "k", 1, 5),
                           ("2022-06-13 00:00:10", "2022-06-13 00:00:20", "k", 2, 0)]
    assert windows.stamped(out).columns[-1] == "ts"


def test_score_bands(frame):
    rows = frame([(t,) for t in ("0", "59.99", "60", "79", "80", "90", "94.9", "95", "100")], "s string")
    out = rows.select("s", values.score_band(values.truncated("s")).alias("band"))
    assert dict(tuples(out)) == {
        "0": "[0, 60)", "59.99": "[0, 60)", "60": "[60, 80)", "79": "[60, 80)", "80": "[80, 90)", "90": "[90, 95)",
        "94.9": "[90, 95)", "95": "[95, 100]", "100": "[95, 100]"}


def test_money_does_not_drift(frame):
    total = frame([("0.1",), ("0.2",), ("1",), ("20.2",), ("300.03",)], "a string").agg(F.sum(values.money("a")))
    assert str(total.first()[0]) == "321.53"


def test_keywords_split_whole_text_and_drop_empty_rows(frame):
    rows = frame([(1, "Flink, Spark! 大数据 flink"), (2, " ,. "), (3, None)], "id int, text string")
    assert tuples(keywords.explode_keywords(rows, "text")) == [
        (1, "flink"), (1, "flink"), (1, "spark"), (1, "大数据")]


def test_version_times_compare_as_times(frame):
    rows = frame([("2022-06-13 10:00:00.1Z", "2022-06-13 10:00:00.100Z", "2022-06-13 10:00:00.02Z")], "a string, b string, c string")
    a, b, c = (times.version_time(n) for n in "abc")
    assert rows.select(a == b, a > c).first() == (True, True)


def test_time_conversions(frame):
    rows = frame([(1655049601234, "1655049601")], "ms bigint, s string")
    out = rows.select(
        times.datetime_text(times.from_epoch_millis("ms")), times.datetime_text(times.from_epoch_seconds("s")),
        times.date_text(times.from_epoch_millis("ms")), times.to_epoch_millis(F.lit("2022-06-12 16:00:01")),
        times.date_id(F.lit("2022-06-12 16:00:01")), times.date_id(F.lit("not a time")),
        times.to_epoch_millis(F.lit("2022-06-12"), times.DATE))
    assert tuple(out.first()) == ("2022-06-12 16:00:01", "2022-06-12 16:00:01", "2022-06-12", 1655049601000,
                                  "2022-06-12", None, 1654992000000)
