"""Sessions, bounces and session starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lyceum.operators.latest import earliest_per_key


def session_rollup(
    df: DataFrame,
    keys: list[str],
    gap_seconds: int,
    sums: dict[str, str],
    firsts: list[str] = (),
    lasts: list[str] = (),
    ts: str = "ts",
    ties: list[str] = (),
) -> DataFrame:
    """One row per key and session; a silence longer than ``gap_seconds`` ends a session.

    ``sums`` maps output to summed column, ``firsts`` and ``lasts`` take the value at the earliest
    and the latest event.  Output: keys, ``session_start``, ``session_end`` (last event plus gap),
    ``events``, then the measures.

    On a stream this is a session window.  In batch, events are first merged per key and time slot
    as wide as the gap: two events in one slot are never further apart, so slots merge safely, and
    a key has at most (time span / gap) of them however many events it has.
    """
    order = [F.col(ts).alias("_ts"), *ties]
    at_first = F.min_by(F.struct(*firsts), F.struct(*order)) if firsts else F.lit(None)
    at_last = F.max_by(F.struct(*lasts), F.struct(*order)) if lasts else F.lit(None)
    totals = [F.sum(c).alias(name) for name, c in sums.items()]
    unpack = [F.col(f"_first.{c}").alias(c) for c in firsts]
    unpack += [F.col(f"_last.{c}").alias(c) for c in lasts]

    if df.isStreaming:
        aggregates = [F.count(F.lit(1)).alias("events"), *totals]
        aggregates += [at_first.alias("_first")] if firsts else []
        aggregates += [at_last.alias("_last")] if lasts else []
        window = F.session_window(ts, f"{gap_seconds} seconds").alias("_session")
        sessions = df.groupBy(*keys, window).agg(*aggregates)
        return sessions.select(
            *keys, F.col("_session.start").alias("session_start"),
            F.col("_session.end").alias("session_end"), "events", *sums, *unpack,
        )

    gap = gap_seconds * 1_000_000
    slot = F.floor(F.unix_micros(ts) / F.lit(gap)).alias("_slot")
    aggregates = [
        F.min(ts).alias("_from"), F.max(ts).alias("_to"), F.count(F.lit(1)).alias("events"), *totals
    ]
    aggregates += [F.min(F.struct(*order, F.struct(*firsts).alias("_v"))).alias("_first")] if firsts else []
    aggregates += [F.max(F.struct(*order, F.struct(*lasts).alias("_v"))).alias("_last")] if lasts else []
    slots = df.groupBy(*keys, slot).agg(*aggregates)

    by_time = W.partitionBy(*keys).orderBy("_slot")
    silence = F.unix_micros("_from") - F.unix_micros(F.lag("_to").over(by_time))
    opens = F.when(silence <= gap, 0).otherwise(1)
    numbered = slots.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(by_time.rowsBetween(W.unboundedPreceding, 0))
    )
    merged = [F.min("_from").alias("session_start"), F.max("_to").alias("_end"),
              F.sum("events").alias("events"), *[F.sum(name).alias(name) for name in sums]]
    merged += [F.min("_first")["_v"].alias("_first")] if firsts else []
    merged += [F.max("_last")["_v"].alias("_last")] if lasts else []
    # Same keys as the window above: no further shuffle.
    sessions = numbered.groupBy(*keys, "_session").agg(*merged)
    end = F.timestamp_micros(F.unix_micros("_end") + F.lit(gap)).alias("session_end")
    return sessions.select(*keys, "session_start", end, "events", *sums, *unpack)


def first_login(df: DataFrame, session: str, user: str, ts: str = "ts", ties: list[str] = ()) -> DataFrame:
    """The first logged-in row of each session."""
    return earliest_per_key(df.where(F.col(user).isNotNull()), session, [ts, *ties])


def bounces(
    df: DataFrame,
    visitor: str,
    is_start: Column,
    within_seconds: int = 10,
    ts: str = "ts",
    ties: list[str] = (),
    slice_seconds: int | None = None,
) -> DataFrame:
    """Session starts after which the visitor left: the next row is another start, or does not
    come within ``within_seconds``.

    Rows are ordered inside slices of time, so a visitor with very many rows is spread over many
    tasks.  Each slice also sees the first row of the next one; no slice is shorter than the limit,
    so a row further away is too late anyway.
    """
    slice_seconds = max(slice_seconds or 60 * within_seconds, within_seconds)
    rows = df.withColumn("_start", F.coalesce(is_start, F.lit(False))).withColumn(
        "_slice", F.floor(F.unix_micros(ts) / F.lit(slice_seconds * 1_000_000))
    ).withColumn("_peek", F.lit(0))
    first = F.min(F.struct(ts, *ties, "_start")).alias("_first")
    peeks = rows.groupBy(visitor, "_slice").agg(first).select(
        visitor, (F.col("_slice") - 1).alias("_slice"), F.lit(1).alias("_peek"), "_first.*"
    )
    in_order = W.partitionBy(visitor, "_slice").orderBy("_peek", ts, *ties)
    next_start = F.lead("_start").over(in_order)
    wait = F.unix_micros(F.lead(ts).over(in_order)) - F.unix_micros(ts)
    left = next_start.isNull() | next_start | (wait >= within_seconds * 1_000_000)
    return (
        rows.unionByName(peeks, allowMissingColumns=True)
        .withColumn("_left", left)
        .where("_peek = 0 and _start and _left")
        .drop("_start", "_slice", "_peek", "_left")
    )
