"""Time expressions. All of them are independent of the session time zone.

Event time follows the message contract: ``timestamp`` is epoch milliseconds and
event time is that instant truncated to whole seconds (the original job went
through a formatted string; the arithmetic form keeps the truncation and avoids
the ambiguous hour at a daylight-saving change).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_epoch_millis(col: str | Column) -> Column:
    """Epoch milliseconds of a wall-clock (TIMESTAMP_NTZ) value read as UTC.

    Built from the date and time fields, so no session zone is involved;
    sub-millisecond digits are floored.
    """
    c = _c(col)
    day_ms = F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000)
    time_ms = (
        F.hour(c).cast("bigint") * 3_600_000
        + F.minute(c).cast("bigint") * 60_000
        + F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("bigint")
    )
    return day_ms + time_ms


#: Epoch seconds of the first and the last second of years 1 to 9999.
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799


def odd_time(millis: str | Column = "timestamp") -> Column:
    """True for a time that is there but outside years 1 to 9999 (for example microseconds sent as
    milliseconds)."""
    seconds = (_c(millis) / F.lit(1000)).cast("bigint")
    return F.coalesce(~seconds.between(_FIRST_SECOND, _LAST_SECOND), F.lit(False))


def event_time(millis: str | Column = "timestamp") -> Column:
    """Event time from epoch milliseconds, truncated to whole seconds.

    Integer division truncates toward zero like the original seconds
    conversion did, so -1 ms maps to the epoch; null stays null, and a time
    outside years 1 to 9999 is null instead of stopping the job.
    """
    seconds = (_c(millis) / F.lit(1000)).cast("bigint")
    return F.timestamp_seconds(F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds))


def utc_wall_clock(col: str | Column) -> Column:
    """TIMESTAMP (an instant) to TIMESTAMP_NTZ holding its UTC wall clock."""
    micros = F.unix_micros(_c(col)).cast("decimal(20,0)")
    return F.expr(_NTZ_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), micros / F.lit(1_000_000)
    )


def utc_day(col: str | Column) -> Column:
    """The UTC calendar day of an instant."""
    seconds = F.unix_seconds(_c(col))
    return F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int"))


def local_wall_clock(col: str | Column, zone: str = "UTC") -> Column:
    """An instant as TIMESTAMP_NTZ holding the wall clock of ``zone``, whatever the session's zone."""
    at = utc_wall_clock(col)
    return at if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), at)


def local_day(col: str | Column, zone: str = "UTC") -> Column:
    """The calendar day of an instant in ``zone``."""
    return utc_day(col) if zone == "UTC" else F.to_date(local_wall_clock(col, zone))


def window_label(start: str | Column, end: str | Column) -> Column:
    """``HH:mm-HH:mm`` label of a window, as the dashboard shows it."""
    return F.concat(
        F.date_format(_c(start), "HH:mm"), F.lit("-"), F.date_format(_c(end), "HH:mm")
    )
