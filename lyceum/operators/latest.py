"""Keep one row per key.

``row_number() = 1`` lets Spark cut each map task's rows to one per key before the shuffle
(a partial window-group limit), so a key with a third of all rows sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest_per_key(df: DataFrame, keys: list[str] | str, order: list[str | Column]) -> DataFrame:
    """Newest version of each key; ``order`` lists version time first, then tie-breakers."""
    return _first(df, keys, [_col(c).desc_nulls_last() for c in order])


def earliest_per_key(df: DataFrame, keys: list[str] | str, order: list[str | Column]) -> DataFrame:
    return _first(df, keys, [_col(c).asc_nulls_last() for c in order])


def _first(df: DataFrame, keys: list[str] | str, order: list[Column]) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
