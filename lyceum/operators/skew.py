"""Equi joins for inputs in which a few keys hold much of the left side.

The join is a plain one, whose oversized partitions Spark splits at run time.  A caller who knows that
this is not enough (a split partition still meets the whole right side of its key in every task) asks for
salting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A salted key is hot above this share of the rows, so there are at most 100,000 hot keys whatever the
# size of the table.
HOT_SHARE = 1e-5
# Rows of a hot key that one slice takes.
SLICE_ROWS = 1_000_000


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(key_hash, slices) of the keys with more than ``share`` of all rows and more than one slice.

    Counts are pre-aggregated in each map task and read the key columns only.  Keys go by their hash: 12
    bytes for each of at most 1 / share keys.  Keys that share a hash are salted alike, which does no harm."""
    counts = df.dropna(subset=keys).groupBy(key_hash(keys).alias("key_hash")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    hot = counts.where((F.col("rows") > slice_rows) & (F.col("rows") > total * share))
    return hot.select("key_hash", F.ceil(F.col("rows") / slice_rows).cast("int").alias("slices"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    salted: bool = False,
    share: float = HOT_SHARE,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Join on ``keys``; ``salted`` spreads the hot keys of ``left`` over slices, by their counts.

    Rows of a hot key get a slice from a hash of their content, which a re-run task computes again
    exactly; the matching right rows are repeated once per slice.  Every pair meets in exactly one
    slice, so the result equals the plain join.  ``how`` is ``inner`` or ``left``."""
    if how not in ("inner", "left"):
        raise ValueError("repeated right rows are only harmless in inner and left joins")
    if not salted:
        return left.join(right, keys, how)
    # At most 1 / share rows of two numbers.
    hot = F.broadcast(hot_keys(left, keys, share, slice_rows)
                      .withColumnsRenamed({"key_hash": "_hash", "slices": "_slices"}))
    hashable = [f.name for f in left.schema if not _holds_map(f.dataType)]
    # Rows without a key match nothing, so they may go anywhere.
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    content = F.xxhash64(*hashable)
    sliced_left = left.withColumn("_hash", key_hash(keys)).join(hot, "_hash", "left").withColumn(
        "_slice", F.when(keyless, content).otherwise(F.pmod(content, F.coalesce("_slices", F.lit(1)).cast("long")))
    ).drop("_hash", "_slices")
    sliced_right = right.withColumn("_hash", key_hash(keys)).join(hot, "_hash", "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_slices", F.lit(1)).cast("long") - 1))
    ).drop("_hash", "_slices")
    return sliced_left.join(sliced_right, [*keys, "_slice"], how).drop("_slice")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return False
