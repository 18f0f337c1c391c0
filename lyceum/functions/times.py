"""Epoch, date and text conversions, all in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def from_epoch_seconds(c: Column | str) -> Column:
    """Change-record time: seconds since 1970, usually as text."""
    return F.timestamp_seconds(_col(c).try_cast("long"))


def from_epoch_millis(c: Column | str) -> Column:
    """Log time: milliseconds since 1970."""
    return F.timestamp_millis(_col(c).try_cast("long"))


def millis_to_second(c: Column | str) -> Column:
    """Log time cut to whole seconds."""
    return F.date_trunc("second", from_epoch_millis(c))


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE)


def datetime_text(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_TIME)


def date_id(c: Column | str) -> Column:
    """``yyyy-MM-dd`` of a date-time given as text; null when the text is not a time."""
    return F.date_format(F.try_to_timestamp(_col(c)), DATE)


def to_epoch_millis(c: Column | str, fmt: str = DATE_TIME) -> Column:
    """Milliseconds of a date or date-time given as text."""
    return F.unix_millis(F.to_timestamp(_col(c), fmt))


def now_millis() -> Column:
    """Emit time of a summary row, cut to seconds."""
    return F.unix_timestamp(F.current_timestamp()) * F.lit(1000)


def version_time(c: Column | str) -> Column:
    """A row version's time.  Text such as ``2022-06-13 10:00:00.123Z`` is parsed, not compared as
    text, so ``.1`` and ``.100`` are the same instant."""
    return F.to_timestamp(F.regexp_replace(_col(c), "Z$", ""))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
