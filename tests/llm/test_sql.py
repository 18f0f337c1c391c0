"""Registered operators that SQL can express, and the registry itself."""

import duckdb
import pytest
from check import TABLES, compare

import __spark_entry__ as entry_points
from lyceum.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    good, note = compare(spark, connection, name, SF)
    assert good, note


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["op3_quality_rules", "op6_exact_dedup", "op10_pseudonyms"])
def test_native_plans_have_no_python(spark, name):
    plan = entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
