"""Closing rows of replayed streams reach every stage, whatever the newest rows of the table are."""

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from lyceum.queries import streams
from lyceum.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def without_late_searches(spark, tmp_path_factory):
    """Events whose newest rows of each kind are no searches and have no user."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = spark.read.schema(tables.SCHEMAS["events"]).parquet(f"{SF}/events.parquet")
    late = F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz")
    events.withColumn("props", F.when(late, F.lit('{"k": 10}')).otherwise(F.col("props"))).write.parquet(f"{folder}/events.parquet")
    return folder


def test_the_last_keyword_window_is_written(spark, without_late_searches):
    windows = streams.stream_keyword_window(spark, without_late_searches)
    pages = streams.pages_of(tables.events(spark, without_late_searches))
    wanted = streams.summaries.dws_traffic_source_keyword_page_view_window(pages, streams.HOUR)
    assert tuples(windows) == tuples(wanted)


def test_closing_rows_pass_each_filter(spark, without_late_searches):
    *_, closing = streams.event_pieces(spark, without_late_searches)
    pages = streams.pages_of(closing.withColumn("k", F.get_json_object("props", "$.k").cast("int")))
    assert {r[0] for r in pages.select("page.page_id").distinct().collect()} == {
        "home", "course_list", "course_detail", "order", "search"}
    assert pages.where("common.uid IS NOT NULL AND page.last_page_id IS NULL").count() > 0
    assert closing.select("user_id").distinct().count() == closing.count()
