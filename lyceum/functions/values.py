"""Casts and small value functions used by the summaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(16,2)"

# Upper bound (exclusive) and label of each score band; the last band is closed.
SCORE_BANDS = [(60, "[0, 60)"), (80, "[60, 80)"), (90, "[80, 90)"), (95, "[90, 95)")]
TOP_BAND = "[95, 100]"


def money(c: Column | str) -> Column:
    """Exact amounts: floats drift when summed.  What is no number is null."""
    return _col(c).try_cast(MONEY)


def truncated(c: Column | str) -> Column:
    """A number given as text, cut (not rounded) to a whole number; null if it is none."""
    return _col(c).try_cast("double").try_cast("long")


def score_band(score: Column | str) -> Column:
    """The band of a score; null for an unknown one."""
    score = _col(score)
    first_bound, first_label = SCORE_BANDS[0]
    band = F.when(score < first_bound, F.lit(first_label))
    for bound, label in SCORE_BANDS[1:]:
        band = band.when(score < bound, F.lit(label))
    return band.when(score.isNotNull(), F.lit(TOP_BAND))


def one_if(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also when it is unknown)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
