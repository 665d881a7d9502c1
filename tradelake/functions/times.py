"""Time columns. Every function expects the session zone to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years 1 to 9999, the span a formatted four-digit year can show.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799

PARTS = ["year", "month", "day", "hour"]
PADDED = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
PLAIN = {"year": "yyyy", "month": "M", "day": "d", "hour": "H"}


def event_time(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp; seconds outside years 1 to 9999 give null."""
    value = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(value.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(value))


def hour_text(ts: Column) -> Column:
    """``2024-01-31T07``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def hour_start(seconds: Column | str) -> Column:
    """Epoch seconds at the start of the hour; null where :func:`event_time` is null.

    One to one with :func:`hour_text`, and much cheaper to group and sort by.
    """
    value = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(value.between(FIRST_SECOND, LAST_SECOND), value - F.pmod(value, F.lit(3600)))


def year_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def iso_text(ts: Column) -> Column:
    """``2024-01-31T07:05:09Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def hour_bucket(ts: Column) -> Column:
    """Start of the fixed one-hour window the time falls in."""
    return F.date_trunc("hour", ts)


def number_parts(ts: Column) -> dict[str, Column]:
    """Year, month, day and hour as integers."""
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}


def padded_parts(ts: Column, last: str = "hour") -> dict[str, Column]:
    """Zero-padded path parts from year down to ``last``."""
    return _formatted(ts, PADDED, last)


def plain_parts(ts: Column, last: str = "hour") -> dict[str, Column]:
    """Path parts without leading zeros from year down to ``last``."""
    return _formatted(ts, PLAIN, last)


def _formatted(ts: Column, patterns: dict[str, str], last: str) -> dict[str, Column]:
    wanted = PARTS[: PARTS.index(last) + 1]
    return {part: F.date_format(ts, patterns[part]) for part in wanted}
