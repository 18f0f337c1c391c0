"""First sightings: per key and day, or ever.

In batch, "the first of the day" is ``min(ts)`` per key and day: a hash aggregate that shrinks a
hot key inside each map task.  On a stream it is a value per key (``streaming.state``) when a window
aggregate follows, or else ``dropDuplicates`` on key and day window, whose state is dropped when the
watermark passes the end of that day.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lyceum.operators.latest import earliest_per_key
from lyceum.operators.skew import skew_join
from lyceum.streaming import state


def day_window(df: DataFrame, ts: str) -> Column:
    """The calendar day of ``ts`` as a window struct, aligned to the session time zone."""
    zone = ZoneInfo(df.sparkSession.conf.get("spark.sql.session.timeZone"))
    shift = -int(datetime(2024, 1, 1, tzinfo=zone).utcoffset().total_seconds()) % 86400
    return F.window(ts, "1 day", startTime=f"{shift} seconds")


def first_sightings(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """(keys, ts): the first event of each key on each day."""
    if df.isStreaming:
        return state.first_of_day(df.select(*keys, ts), keys, ts, forget=True).drop("is_new", "is_back")
    return (
        df.groupBy(*keys, F.to_date(ts).alias("_day")).agg(F.min(ts).alias(ts)).drop("_day")
    )


def first_ever(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """(keys, ts): the first event of each key.  On a stream the keys are remembered for good."""
    if df.isStreaming:
        return df.select(*keys, ts).dropDuplicates(keys)
    return df.groupBy(*keys).agg(F.min(ts).alias(ts))


def first_rows_of_day(df: DataFrame, keys: list[str], ts: str = "ts", ties: list[str] = ()) -> DataFrame:
    """The whole first row of each key on each day."""
    if df.isStreaming:
        # Only the day may carry the watermark here, so the time is rebuilt as a plain column.
        plain_time = F.timestamp_micros(F.unix_micros(ts))
        rows = df.withColumn("_day", day_window(df, ts)).withColumn(ts, plain_time)
        return rows.dropDuplicates([*keys, "_day"]).drop("_day")
    with_day = df.withColumn("_day", F.to_date(ts))
    return earliest_per_key(with_day, [*keys, "_day"], [ts, *ties]).drop("_day")


def flag_first_of_day(
    df: DataFrame, keys: list[str], row_id: list[str], ts: str = "ts", flag: str = "is_first"
) -> DataFrame:
    """Every row, with 1 on the first of its key and day (ties: smallest ``row_id``), else 0.

    The winners are found by aggregation and matched back on the row's own id, so no task ever
    holds all rows of a key.  ``row_id`` must identify a row.
    """
    named = [F.col(c).alias(f"_id{i}") for i, c in enumerate(row_id)]
    winners = (
        df.groupBy(*keys, F.to_date(ts).alias("_day"))
        .agg(F.min(F.struct(F.col(ts).alias("_ts"), *named)).alias("_first"))
        .select(*[F.col(f"_first._id{i}").alias(c) for i, c in enumerate(row_id)])
        .withColumn(flag, F.lit(1).cast("long"))
    )
    return df.join(winners, row_id, "left").withColumn(flag, F.coalesce(flag, F.lit(0).cast("long")))


def returning_users(df: DataFrame, user: str, ts: str = "ts", away_days: int = 8) -> DataFrame:
    """(user, ts, uv_count, back_count): one row per user and day; ``back_count`` is 1 when the
    user's previous day lies at least ``away_days`` back."""
    days = first_sightings(df.where(F.col(user).isNotNull()), [user], ts)
    today = F.to_date(ts)
    # Holds at most one row per calendar day of a user.
    previous = F.lag(today).over(W.partitionBy(user).orderBy(today))
    away = F.datediff(today, previous) >= away_days
    return days.select(
        user,
        ts,
        F.lit(1).cast("long").alias("uv_count"),
        F.when(away, 1).otherwise(0).cast("long").alias("back_count"),
    )


def repair_new_visitor(
    df: DataFrame, visitor: str = "mid", flag: str = "is_new", ts: str = "ts", ties: list[str] = (),
    **join_options,
) -> DataFrame:
    """Clear a wrong new-visitor flag.

    A visitor's first date is the date of the first row when that row claims to be new, else the
    day before it.  A later claim on any other date is wrong.
    """
    first = F.min(F.struct(F.col(ts).alias("t"), *ties, F.col(flag).alias("f")))
    seen = (
        df.where(F.col(visitor).isNotNull())
        .groupBy(visitor)
        .agg(first.alias("_first"))
        .select(
            visitor,
            F.when(F.col("_first.f") == "1", F.to_date("_first.t"))
            .otherwise(F.date_sub(F.to_date("_first.t"), 1))
            .alias("_first_date"),
        )
    )
    wrong = (F.col(flag) == "1") & (F.to_date(ts) != F.col("_first_date"))
    return (
        skew_join(df, seen, [visitor], "left", **join_options)
        .withColumn(flag, F.when(wrong, F.lit("0")).otherwise(F.col(flag)))
        .drop("_first_date")
    )
