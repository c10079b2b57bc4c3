"""Event-time arithmetic on epoch milliseconds.

A sliding window starts at a multiple of ``slide``, includes its start and
excludes its end; it is named by its end. All values are plain ``bigint``
expressions, so they stay inside generated code and need no time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
_EPOCH_UTC = "timestamp'1970-01-01 00:00:00Z'"


def align_down(ms: Column, step: int) -> Column:
    """Largest multiple of ``step`` that is not above ``ms``; right below zero too."""
    return ms - F.pmod(ms, F.lit(step).cast("bigint"))


def first_window_end(ts_ms: Column, size: int, slide: int) -> Column:
    """End of the earliest window that holds ``ts_ms``."""
    return align_down(ts_ms - size, slide) + (slide + size)


def last_window_end(ts_ms: Column, size: int, slide: int) -> Column:
    """End of the latest window that holds ``ts_ms``."""
    return align_down(ts_ms, slide) + size


def last_end_reached(ms: Column, size: int, slide: int) -> Column:
    """Largest window end that is not above ``ms``."""
    return align_down(ms - size, slide) + size


def interval(ms: int) -> str:
    """An interval string for ``F.window`` and ``withWatermark``."""
    return f"{ms} milliseconds"


def utc_instant(ts_ntz: Column) -> Column:
    """The instant of a zone-less UTC timestamp, whatever the session zone is."""
    return F.expr(_EPOCH_UTC) + (ts_ntz - F.expr(_EPOCH_NTZ))


def utc_millis(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC timestamp, floored."""
    return F.unix_millis(utc_instant(ts_ntz))


def display_time(ms: Column, zone: str = "UTC") -> Column:
    """Wall-clock text with at least one digit of the fraction: ``2024-01-01 10:05:00.0``."""
    seconds = (ms / F.lit(1000)).cast("decimal(18,6)")
    utc = F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    text = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, "0{1,2}$", "")
