"""Streams whose later pieces change what earlier ones gave: late partners, versions, deletions, late rows."""

import datetime as dt

from helpers import tuples
from pyspark.sql import functions as F

from lyceum import schemas
from lyceum.operators.joins import MATCHED, left_with_updates
from lyceum.operators.windows import watermark
from lyceum.sources import feeds
from lyceum.streaming import jobs

DAY0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return DAY0 + dt.timedelta(seconds=seconds)


def test_left_rows_come_at_once_and_again_with_each_partner(spark, frame):
    left, right = "k string, n int, lt timestamp", "rk string, v string, rt timestamp"
    pieces = [
        {"left": frame([("a", 1, at(10)), ("b", 2, at(11)), (None, 3, at(12))], left), "right": frame([("b", "early", at(5))], right)},
        {"left": frame([("c", 4, at(20))], left), "right": frame([("a", "late", at(18)), ("a", "far", at(60)), (None, "none", at(19))], right)},
    ]
    out, counts = jobs.KeyedTable(spark, "left", ["n"], ["lt", MATCHED]), []

    def run(feed):
        out.fill(left_with_updates(watermark(feed["left"], "lt"), watermark(feed["right"], "rt"), "k", "rk", "lt", "rt", "10 seconds"))
        counts.append(tuples(out.read(), "n", "v"))

    jobs.replay_feeds(spark, pieces, run, "left")
    # Nothing waits for the watermark; the partner of 1 comes with the second piece, one 50 s away does not count.
    assert counts == [[(1, None), (2, "early"), (3, None)], [(1, "late"), (2, "early"), (3, None), (4, None)]]


def test_a_deletion_ends_a_key_whatever_comes_first(spark, frame):
    schema = schemas.ORDER_DETAIL
    text = F.to_json(F.struct("id", "final_amount", "row_op_ts"))
    rows = [("a", "1", at(1)), ("a", "2", at(9)), ("b", "1", at(2)), ("c", "1", at(3))]
    written = frame(rows, "id string, final_amount string, row_op_ts timestamp").select(
        F.to_json(F.struct("id")).alias("key"), text.alias("value"), F.col("row_op_ts").alias("arrival_time"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("arrival"))
    ended = frame([("b", at(5)), ("c", at(1)), ("d", at(1))], "id string, t timestamp").select(
        F.to_json(F.struct("id")).alias("key"), F.lit(None).cast("string").alias("value"), F.col("t").alias("arrival_time"),
        F.lit(0).alias("partition"), F.lit(99).cast("long").alias("arrival"))
    for first, second in ((written, ended), (ended, written)):
        out = jobs.KeyedTable(spark, "ends", ["id"], ["row_op_ts"])
        jobs.replay_feeds(spark, [{"rows": first}, {"rows": second}],
                          lambda feed, out=out: out.fill(feeds.keyed_versions(feed["rows"], schema, ["id"])), "ends")
        # b ended after its version, c before it, d had none.
        assert tuples(out.read("deleted"), "id", "final_amount") == [("a", "2"), ("c", "1")]


def test_records_of_a_topic_keep_their_place(frame):
    raw = frame([(b"k", b"v", "t", 3, 17, DAY0)], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    assert tuples(feeds.topic_records(raw)) == [("k", "v", 3, 17, DAY0)]


def test_place_of_arrival_in_a_file(spark, frame, tmp_path):
    path = str(tmp_path / "rows")
    frame([(1,), (2,)], "n int").coalesce(1).write.parquet(path)
    got = spark.read.parquet(path).select("n", feeds.file_arrival().alias("a")).select("n", "a.row", "a.path").collect()
    assert sorted((r.n, r.row) for r in got) == [(1, 0), (2, 1)] and all(r.path.endswith(".parquet") for r in got)


def test_late_rows_go_to_a_table_of_their_own(spark, frame):
    schema = "n int, ts timestamp"
    pieces = [{"rows": frame(rows, schema)} for rows in (
        [(1, at(100)), (2, at(200)), (3, None)], [(4, at(194)), (5, at(195)), (6, at(300))], [], [(7, at(296)), (8, at(294))])]
    split = jobs.LateRows(spark, "late", "ts", "5 seconds")
    jobs.replay_feeds(spark, pieces, lambda feed: split.split(feed["rows"]), "late")
    assert tuples(split.in_time(), "n") == [(1,), (2,), (5,), (6,), (7,)]
    assert tuples(split.late(), "n") == [(3,), (4,), (8,)]
    # A replayed batch reads the marks of earlier batches only.
    before = tuples(split.late(), "n")
    split.write(frame([(4, at(194)), (5, at(195)), (6, at(300))], schema), 1)
    assert tuples(split.late(), "n") == before
