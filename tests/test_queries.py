"""Registered queries: against their SQL, and the shape of their plans."""

import duckdb
import pytest
from check import TABLES, compare

import __spark_entry__ as entry_points
from lyceum.queries import catalog

SF = "/root/testdata/sf0.001"
BATCH = [n for n in catalog.QUERIES if not n.startswith("stream_")]
# The others are run by tools/check.py; tests/test_streaming.py covers their operators.
STREAMS = ["stream_learn_play", "stream_dimension_upsert", "stream_bounces"]


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_cross_joins_and_no_python(df):
    plan = plan_of(df)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


@pytest.mark.parametrize("name", BATCH + STREAMS)
def test_equals_sql(spark, connection, name):
    good, note = compare(spark, connection, name, SF, no_cross_joins_and_no_python)
    assert good, note


def test_versions_are_cut_to_one_per_key_before_the_shuffle(spark):
    plan = plan_of(entry_points.queries()["keyed_latest_version"](spark, SF))
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_scans_read_only_the_columns_needed(spark):
    plan = plan_of(entry_points.queries()["keyed_first_ever"](spark, SF))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "o_custkey" in schema and "o_orderdate" in schema and "o_totalprice" not in schema


def test_filters_reach_the_scan(spark):
    plan = plan_of(entry_points.queries()["dwd_interaction_review"](spark, SF))
    assert "EqualTo(event_type,view)" in plan


def test_entry_is_the_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_points.queries())


def test_order_summaries_do_not_read_the_page_log(spark):
    for name in ("dws_trade_order_window", "dws_trade_course_order_window"):
        assert "events.parquet" not in plan_of(entry_points.queries()[name](spark, SF))


def test_dimensions_are_joined_one_by_one(spark):
    plan = plan_of(entry_points.queries()["dws_trade_course_order_window"](spark, SF))
    joins = [line for line in plan.split("\n") if "Join" in line and ("subject_id" in line or "category_id" in line)]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
