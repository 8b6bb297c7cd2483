"""Time columns. None depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def from_millis(ms: Column) -> Column:
    """Epoch (or game-relative) milliseconds to a timestamp, exact to the millisecond."""
    return F.timestamp_millis(ms)


def minute_truncated(ms: Column) -> Column:
    """Whole minutes, cut toward zero: the batch rule."""
    return (ms / 60000).cast("int")


def minute_floored(ms: Column) -> Column:
    """Whole minutes, rounded down: the message rule. Differs below zero only."""
    return F.floor(ms / 60000).cast("long")


def utc_date(ms: Column) -> Column:
    """UTC calendar date of epoch milliseconds."""
    return F.date_from_unix_date(F.floor(ms / DAY_MS).cast("int"))


def day_seconds(ds: Column) -> tuple[Column, Column]:
    """First and last epoch second of a date, both inclusive."""
    first = F.unix_date(ds).cast("long") * 86400
    return first, first + 86399


def within_day(epoch_seconds: Column, ds: Column) -> Column:
    first, last = day_seconds(ds)
    return epoch_seconds.between(first, last)


def parse_date(text: Column) -> Column:
    return F.to_date(text, "yyyy-MM-dd")


def trailing_start(as_of: Column, days: int = 90) -> Column:
    """First date of a trailing window."""
    return F.date_sub(as_of, days)
