"""Registered queries: a Spark function of (spark, sf_dir) and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lyceum.session import prepare, sized

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(sized(prepare(spark)), sf_dir)

        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return fn

    return register
