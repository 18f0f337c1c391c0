"""Dimension lookups and the configuration-driven dimension feed.

Lookups are plain left joins.  Spark broadcasts a dimension when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond it; nothing here forces a
broadcast of a table that may grow.  Summaries look dimensions up after aggregating, so the left
side is small and has no hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lyceum.operators.latest import latest_per_key


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Left join on one or several key columns.

    ``on`` maps a column of ``df`` to a key of ``dim``; ``take`` maps columns of ``dim`` to output
    names.  A missing row leaves nulls.
    """
    keys = {right: f"_key{i}" for i, right in enumerate(on.values())}
    side = dim.select(
        *[F.col(c).alias(k) for c, k in keys.items()], *[F.col(c).alias(a) for c, a in take.items()]
    )
    condition = None
    for left, right in on.items():
        equal = df[left] == side[keys[right]]
        condition = equal if condition is None else condition & equal
    return df.join(side, condition, "left").drop(*keys.values())


def lookups(df: DataFrame, *steps: tuple[DataFrame, str, dict[str, str]]) -> DataFrame:
    """Lookups by ``id``, one after the other: (dimension, column of the rows, what to take).

    Each dimension is joined by itself, so Spark judges each by its own size.  Joined among themselves
    first, small dimensions would count as one as large as their product, and be shuffled."""
    for dim, key, take in steps:
        df = lookup(df, dim, {key: "id"}, take)
    return df


def fold_config(changes: DataFrame, order: list[str | Column]) -> DataFrame:
    """Current configuration from its change log: newest change per source table, deletions gone.

    A change without an operation is malformed and ignored.
    """
    deleted = F.col("op") == "d"
    named = changes.where(F.col("op").isNotNull()).withColumn(
        "source_table", F.when(deleted, F.col("before.source_table")).otherwise(F.col("after.source_table"))
    )
    newest = latest_per_key(named, "source_table", order).where(~deleted)
    fields = ["sink_table", "sink_columns", "sink_pk", "sink_extend"]
    return newest.select("source_table", *[F.col(f"after.{f}").alias(f) for f in fields])


def keep_columns(data: Column | str, listed: Column | str) -> Column:
    """Entries of a map whose name is in a comma-separated list (whole names)."""
    data = F.col(data) if isinstance(data, str) else data
    listed = F.col(listed) if isinstance(listed, str) else listed
    names = F.transform(F.split(listed, ","), lambda name: F.trim(name))
    return F.map_filter(data, lambda name, _: F.array_contains(names, name))


def dimension_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change records of configured tables, cut to the configured columns.

    Output: ``sink_table``, ``sink_pk``, ``type``, ``data``, ``ts``.  Tables without configuration
    and records without a type are dropped.
    """
    side = config.select("source_table", "sink_table", "sink_columns",
                         F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"))
    routed = changes.where(F.col("type").isNotNull()).join(
        side, F.col("table") == F.col("source_table"), "inner"
    )
    return routed.select(
        "sink_table", "sink_pk", "type", keep_columns("data", "sink_columns").alias("data"), "ts"
    )


def dimension_rows(routed: DataFrame, sink_table: str, columns: list[str], pk: str = "id") -> DataFrame:
    """Current rows of one dimension: newest change per key, every column as text, and its change
    time as ``_version``.  A deletion in the source keeps the row, as an upsert."""
    rows = routed.where(F.col("sink_table") == sink_table).select(
        F.element_at("data", pk).alias("_pk"),
        F.col("ts").cast("long").alias("_version"),
        *[F.element_at("data", c).alias(c) for c in columns],
    )
    known = rows.where(F.col("_pk").isNotNull())
    return latest_per_key(known, "_pk", ["_version", *columns]).drop("_pk")
