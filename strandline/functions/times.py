"""Time helpers (F4, F5, F8-F11). Nothing here reads the clock, callers pass ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest whole second that fits a 64-bit count of microseconds.
MAX_EPOCH_SECONDS = (2**63 - 1) // 1_000_000


def from_epoch_seconds(value: Column) -> Column:
    """Epoch seconds as a timestamp.

    A value beyond the timestamp range gives NULL. ``timestamp_seconds`` alone would raise, and one
    such message would then stop a stream for good.
    """
    in_range = value.between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.timestamp_seconds(F.when(in_range, value))


def instant(value: str | datetime | Column) -> Column:
    """An operator-supplied point in time.

    Text without an offset is read in the session zone, ``Z`` and offsets are honoured (H10). Bad text
    raises, on purpose: a wrong cutoff must not become NULL.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = iso_utc(value)
    return F.to_timestamp(F.lit(value))


def iso_utc(value: datetime | int) -> str:
    """A zone-free text for an aware datetime or a count of epoch microseconds."""
    if isinstance(value, int):
        value = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=value)
    if value.tzinfo is None:
        raise ValueError("give a datetime with a zone, or text")
    return value.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def seconds(n: int) -> Column:
    """An interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n))


def within(earlier: Column, later: Column, limit_seconds: int) -> Column:
    """``later - earlier <= limit``, to the microsecond."""
    return (later - earlier) <= seconds(limit_seconds)


def age_seconds(earlier: Column, later: Column) -> Column:
    """Whole seconds between two instants, each cut to its second."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def iso_text(value: Column) -> Column:
    """ISO text of a timestamp in the session zone."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def utc_day(value: Column) -> Column:
    """The day in UTC as ``yyyy-mm-dd``, whatever the session zone is."""
    whole = F.unix_seconds(value)
    days = (whole - F.pmod(whole, F.lit(86_400))) / F.lit(86_400)
    return F.date_from_unix_date(days.cast("int")).cast("string")
