"""Joins between feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lyceum.operators.skew import skew_join
from lyceum.streaming.joins import join_within


def join_feeds(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    left_ts: str | None = None,
    right_ts: str | None = None,
    within: str | None = None,
    **join_options,
) -> DataFrame:
    """Equi join of two feeds, optionally limited to rows whose times lie ``within`` each other.

    Streams need the time limit: it is what lets Spark forget old rows.  In batch, rows meet by key and
    slice of time as long as the limit, the right ones repeated in the slices next to theirs, so a key
    forms no pairs but those of neighbouring slices.  Column names other than the keys must differ.
    """
    if within is None and not left.isStreaming:
        renamed = right.withColumnRenamed(right_key, left_key)
        return skew_join(left, renamed, [left_key], how, **join_options)
    close = near(left[left_ts], right[right_ts], within)
    if not left.isStreaming:
        span = F.lit(span_seconds(within) * 1_000_000)
        place = F.floor(F.unix_micros(right_ts) / span)
        left = left.withColumn("_slice", F.floor(F.unix_micros(left_ts) / span))
        right = right.withColumn("_near", F.explode(F.array(place - 1, place, place + 1)))
        same = (left[left_key] == right[right_key]) & (left["_slice"] == right["_near"])
        joined = left.join(right, same & near(left[left_ts], right[right_ts], within), how).drop("_slice", "_near")
        return joined if left_key == right_key else joined.drop(right_key)
    joined = left.join(right, (left[left_key] == right[right_key]) & close, how)
    return joined if left_key == right_key else joined.drop(right_key)


# When the partner of a row was seen; null in the row that came first, without one.
MATCHED = "matched_at"


def left_with_updates(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, within: str,
    seen: str | None = None,
) -> DataFrame:
    """Changelog of a left join of two streams.

    Each left row comes at once without partner, and again, as a later version, for each partner found at
    most ``within`` away in time, whichever of the two arrives first.  ``matched_at`` is the partner's time.
    A keyed sink that takes the newest version, then the newest ``matched_at`` (nulls last), holds what a
    left join with the newest partner gives, at any moment and in any order of arrival; nothing is held
    back until a watermark rules a partner out.  Each side's state ends when the watermark passes the limit.
    ``seen`` adds the event time at which a row was known, for a join that follows."""
    found = [f for f in right.schema if f.name != right_key]
    alone = left.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in found])
    matched = join_within(left, right, left_key, right_key, left_ts, right_ts, span_seconds(within), seen)
    alone = alone.withColumn(seen, F.col(left_ts)) if seen else alone
    stamped = [alone.withColumn(MATCHED, F.lit(None).cast("timestamp")),
               matched.withColumn(MATCHED, F.timestamp_micros(F.unix_micros(right_ts)))]
    return stamped[0].unionByName(stamped[1]).drop(right_ts)


def latest_within(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, within: str
) -> DataFrame:
    """Every left row with the newest right row of its key at most ``within`` away in time (batch).

    This is what a keyed sink keeps of a time-limited join, found without forming the pairs: both
    sides are merged by time inside (key, time slice) groups, and each slice also sees the last right
    row of the two slices before it, which is as far as the limit reaches.  A very frequent key is
    spread over its slices.  Adds the columns of ``right`` other than its key; nulls where none fits.
    """
    span = span_seconds(within) * 1_000_000
    found = [c for c in right.columns if c != right_key]
    right_time = F.unix_micros(right_ts)
    hits = right.where(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(right_key).alias(left_key),
        right_time.alias("_at"),
        F.struct(right_time.alias("_t"), *found).alias("_hit"),
    ).withColumn("_slice", F.floor(F.col("_at") / span))
    carried = hits.groupBy(left_key, "_slice").agg(F.max("_hit").alias("_hit")).select(
        left_key,
        F.col("_hit._t").alias("_at"),
        "_hit",
        F.explode(F.array(F.col("_slice") + 1, F.col("_slice") + 2)).alias("_slice"),
    )
    # A left row looks back from the far end of its reach.
    rows = left.withColumn("_at", F.unix_micros(left_ts) + span).withColumn(
        "_slice", F.floor(F.col("_at") / span)
    ).withColumn("_left", F.lit(True))
    merged = rows.unionByName(hits.unionByName(carried), allowMissingColumns=True)
    # Left rows without a key find nothing; each is a group of its own.
    lone = F.when(F.col(left_key).isNull(), F.monotonically_increasing_id())
    by_time = W.partitionBy(left_key, "_slice", lone).orderBy("_at", F.col("_left").asc_nulls_first(), "_hit")
    seen = F.last("_hit", ignorenulls=True).over(by_time.rowsBetween(W.unboundedPreceding, W.currentRow))
    fits = F.col("_seen._t") >= F.col("_at") - 2 * span
    return merged.withColumn("_seen", seen).where("_left").select(
        *left.columns, *[F.when(fits, F.col(f"_seen.{c}")).alias(c) for c in found]
    )


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def span_seconds(within: str) -> int:
    number, unit = within.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def near(a: Column | str, b: Column | str, within: str) -> Column:
    """Two times at most ``within`` apart."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    span = F.expr(f"interval {within}")
    return (b >= a - span) & (b <= a + span)
