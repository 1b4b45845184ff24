"""Date/time column helpers (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a timestamp (fraction truncated), as bigint."""
    return F.unix_timestamp(_c(ts)).cast("long")


def round_to_minute(epoch_s) -> Column:
    """Nearest whole minute (half up) of epoch seconds, as ``timestamp_ntz``."""
    secs = (F.round(_c(epoch_s) / 60.0) * 60).cast("long")
    return F.timestamp_seconds(secs).cast("timestamp_ntz")


def day_range(ts, day: str) -> Column:
    """Half-open ``[day, day + 1)`` predicate on a raw timestamp (pushes down to the scan)."""
    start = F.lit(day).cast("timestamp_ntz")
    return (_c(ts) >= start) & (_c(ts) < F.lit(day).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))


def on_rounded_day(ts, day: str) -> Column:
    """Rows whose minute-rounded timestamp falls on ``day``.

    The raw range is widened by half a minute on both sides so that it still
    pushes down to the scan; the exact test is on the rounded minute.
    """
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    end = start + F.expr("INTERVAL 1 DAY")
    half = F.expr("INTERVAL 31 SECONDS")
    near = (_c(ts) >= start - half) & (_c(ts) < end + half)
    minute = round_to_minute(epoch_seconds(ts))
    return near & (minute >= start) & (minute < end)


def hhmm_minutes(s) -> Column:
    """``'HH:MM'`` → minutes after midnight."""
    s = _c(s)
    return (F.substring(s, 1, 2).cast("int") * 60 + F.substring(s, 4, 2).cast("int"))


def hhmm_minutes_between(first, second, wrap: bool = True) -> Column:
    """Signed minutes from ``first`` to ``second`` (both ``'HH:MM'``).

    With ``wrap`` a difference beyond ±12 h is taken across midnight
    (``23:58 → 00:03`` is +5, not −1435).
    """
    d = hhmm_minutes(second) - hhmm_minutes(first)
    if not wrap:
        return d
    return (F.when(d > 720, d - 1440).when(d < -720, d + 1440).otherwise(d))
