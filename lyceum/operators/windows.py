"""Watermarks and tumbling windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lyceum.functions.times import DATE_TIME, now_millis

WINDOW = "10 seconds"
DELAY = "5 seconds"


def watermark(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    """Bound on lateness; rows later than that are dropped.  Batch input has no late rows."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def tumble(
    df: DataFrame,
    keys: list[str],
    aggregates: list[Column],
    window: str = WINDOW,
    ts: str = "ts",
) -> DataFrame:
    """Aggregate per window and keys; ``stt`` and ``edt`` are the window bounds as text.

    Without keys the aggregate is global per window, still computed as parallel partials.
    """
    grouped = df.groupBy(F.window(ts, window).alias("_w"), *keys).agg(*aggregates)
    bounds = [
        F.date_format("_w.start", DATE_TIME).alias("stt"),
        F.date_format("_w.end", DATE_TIME).alias("edt"),
    ]
    return grouped.select(*bounds, *[c for c in grouped.columns if c != "_w"])


def sums(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def tumble_measures(
    parts: list[DataFrame], keys: list[str], measures: list[str], window: str = WINDOW, ts: str = "ts"
) -> DataFrame:
    """Sum measures that come from several frames of (ts, keys, some measures).

    A measure a frame lacks counts as 0.  One union, one window aggregate.
    """
    kinds = {f.name: f.dataType for part in parts for f in part.schema}

    def full(part: DataFrame) -> DataFrame:
        present = [F.col(m) if m in part.columns else F.lit(0).cast(kinds[m]).alias(m) for m in measures]
        return part.select(ts, *keys, *present)

    rows = reduce(DataFrame.unionByName, [full(p) for p in parts])
    return tumble(rows, keys, sums(measures), window, ts)


def stamped(df: DataFrame) -> DataFrame:
    """Add the emit time as the last column."""
    return df.withColumn("ts", now_millis())
