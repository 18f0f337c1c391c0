"""Dimension tables driven by configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from lyceum import schemas
from lyceum.operators.cleaning import clean_changes
from lyceum.operators.lookup import dimension_changes, dimension_rows, fold_config
from lyceum.sources import feeds, sinks
from lyceum.sources.sinks import BatchWriter


def current_config(config_feed: DataFrame, order: list[str | Column] = ("ts_ms",)) -> DataFrame:
    """Configuration now in force, from its change log as JSON text."""
    return fold_config(feeds.config_changes(config_feed), list(order))


def dim_tables(raw: DataFrame, config_feed: DataFrame, tables: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Current rows of the named dimensions (name -> columns), from raw change text (batch form)."""
    clean, _ = clean_changes(raw, schemas.CHANGE_RECORD)
    routed = dimension_changes(clean, current_config(config_feed))
    return {name: dimension_rows(routed, name, columns).drop("_version") for name, columns in tables.items()}


def dim_writer(root: str, read_config_feed) -> BatchWriter:
    """``foreachBatch`` function for raw change text: clean, route, upsert.

    ``read_config_feed(spark)`` returns the configuration's change log as it stands.
    """
    upsert = sinks.dimension_writer(root, lambda spark: current_config(read_config_feed(spark)))

    def write(batch: DataFrame, batch_id: int) -> None:
        clean, _ = clean_changes(batch, schemas.CHANGE_RECORD)
        upsert(clean, batch_id)
    return write


def read_dimensions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All dimensions the summaries look up, as they stand."""
    return {name: sinks.read_dimension(spark, root, name, schema) for name, schema in schemas.DIMENSIONS.items()}
