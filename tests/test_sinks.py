"""Sinks: replays, versions, column order."""

import json

from helpers import tuples
from pyspark.sql import functions as F, types as T

from lyceum import schemas
from lyceum.session import scratch_path
from lyceum.sources import feeds, sinks, tables


def test_keyed_table_survives_replays_and_compacts(spark, frame):
    path, schema = scratch_path(spark, "t"), "id string, v int, d string"
    write = sinks.keyed_writer(path, ["id"], ["v"])
    write(frame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], schema), 0)
    for _ in range(2):
        write(frame([("a", 2, "later"), ("b", 4, "old")], schema), 1)
    kind = frame([], schema).schema
    now = sinks.read_keyed(spark, path, kind, ["id"], ["v"])
    # Of equal versions the later batch wins; an older version does not.
    assert tuples(now) == [("a", 2, "later"), ("b", 5, "z")]
    target = scratch_path(spark, "compact")
    sinks.compact(spark, path, target, kind, ["id"], ["v"])
    assert tuples(sinks.read_keyed(spark, target, kind, ["id"], ["v"])) == tuples(now)


def test_dimension_is_created_upserted_and_keeps_text(spark, frame):
    root = scratch_path(spark, "dims")
    schema = sinks.ensure_dimension(spark, root, "dim_a", "id, name")
    assert [f.dataType for f in schema] == [T.StringType()] * 2
    assert sinks.read_dimension(spark, root, "dim_a", schema).count() == 0
    configured = [("a", "dim_a", "id,name", None, None)]

    def changes(*rows):
        return frame([("edu", table, kind, data, ts) for table, kind, data, ts in rows], schemas.CHANGE_RECORD)

    write = sinks.dimension_writer(root, lambda session: session.createDataFrame(configured, schemas.CONFIG_ROW))
    write(changes(("a", "insert", {"id": "9 = 'ha'", "name": "'9 = 'ha''", "price": "1"}, "1"),
                  ("a", "insert", {"id": "2", "name": "x"}, "9"), ("a", "update", {"id": "2", "name": "y"}, "10"),
                  ("b", "insert", {"code": "k"}, "1")), 0)
    # A table configured while the stream runs counts from the next micro-batch on.
    configured.append(("b", "dim_b", "code,label", "code", None))
    write(changes(("a", "delete", {"id": "2", "name": "gone"}, "11"), ("b", "insert", {"code": "m", "label": "M"}, "2")), 1)
    write(changes(("a", "update", {"id": "2", "name": "late"}, "3")), 2)
    assert tuples(sinks.read_dimension(spark, root, "dim_a", schema)) == [("2", "gone"), ("9 = 'ha'", "'9 = 'ha''")]
    other = sinks.dimension_schema("code,label")
    assert tuples(sinks.read_dimension(spark, root, "dim_b", other, "code")) == [("m", "M")]


def test_summary_columns_keep_their_order_and_helpers_stay_out(spark, frame):
    rows = frame([("h", 1, "k")], "helper string, n int, key string")
    path = scratch_path(spark, "summary")
    write = sinks.summary_writer(path, ["key", "n"])
    write(rows, 3)
    write(rows, 3)
    back = spark.read.parquet(path).drop("batch_id")
    assert back.columns == ["key", "n"] and back.count() == 1


def test_json_values_round_trip(frame):
    rows = frame([("a", 1)], "id string, n int")
    value = sinks.json_values(rows, ["id"]).first()
    assert json.loads(value.key) == {"id": "a"} and json.loads(value.value) == {"id": "a", "n": 1}


def test_typed_feeds_drop_tombstones(frame):
    topic = frame([('{"id":"1","final_amount":"2.5","row_op_ts":"2022-06-13 10:00:00.123Z"}',), (None,)], "value string")
    rows = feeds.order_details(topic)
    assert tuples(rows, "id", "final_amount") == [("1", "2.5")]
    assert rows.select(F.date_format("row_op_ts", "HH:mm:ss.SSS")).first()[0] == "10:00:00.123"


def test_kafka_options():
    options = feeds.kafka_options("b:9092", "topic_db", "dim_sink_app")
    assert options == {"kafka.bootstrap.servers": "b:9092", "subscribe": "topic_db", "startingOffsets": "latest",
                       "groupIdPrefix": "dim_sink_app"}


def test_change_feed_filter_reads_one_table(spark):
    feed = tables.change_feed(spark, "/root/testdata/sf0.001")
    plan = feed.where("`table` = 'order_info'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "orders.parquet" in plan
