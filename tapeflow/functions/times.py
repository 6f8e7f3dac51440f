"""Epoch milliseconds and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

FIRST_MS = -62_135_596_800_000
LAST_MS = 253_402_300_799_999


def floor_div(value: Column, unit: int) -> Column:
    """Integer division that rounds down for negative values as well."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit))


def is_time(event_time: Column) -> Column:
    """Epoch ms that fall in the years 1 to 9999.

    Any bigint can arrive as a time; converting one out of range would fail the job.
    """
    return event_time.between(FIRST_MS, LAST_MS)


def seconds_time(event_time: Column | str) -> Column:
    """Epoch ms to a timestamp cut to whole seconds, as integer division does.

    NULL where it is no time.
    """
    ms = F.col(event_time) if isinstance(event_time, str) else event_time
    return F.when(is_time(ms), F.timestamp_seconds(F.call_function("div", ms, F.lit(1000))))


def millis_time(event_time: Column | str) -> Column:
    """Epoch ms to a timestamp at full precision, NULL where it is no time."""
    ms = F.col(event_time) if isinstance(event_time, str) else event_time
    return F.when(is_time(ms), F.timestamp_millis(ms))


def utc_date(ms: int) -> Column:
    """The UTC date of epoch ms, whatever the session's time zone."""
    return F.date_from_unix_date(F.lit(min(max(ms, FIRST_MS), LAST_MS) // DAY_MS))


def query_time(as_of: Column | None = None) -> Column:
    """The time a query is asked, or the one given."""
    return F.current_timestamp() if as_of is None else as_of


def in_range(ts: Column, as_of: Column, back: str = "5 minutes") -> Column:
    """``ts`` lies in the closed range that ends at ``as_of``."""
    return ts.between(as_of - F.expr(f"INTERVAL {back}"), as_of)
