"""Date and hour column expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import HORIZON_DAYS

DateLike = "str | dt.date | Column"


def as_date(value) -> Column:
    """A date literal or column; strings are ISO dates."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def horizon_cap(as_of=None, horizon_days: int = HORIZON_DAYS) -> Column:
    """Last day an open or long range may reach: ``as_of + horizon_days``.

    ``as_of`` defaults to ``current_date()`` (moves every day); pass a date for
    repeatable results.
    """
    base = F.current_date() if as_of is None else as_date(as_of)
    return F.date_add(base, horizon_days)


def clipped_start(start: str, lo=None) -> Column:
    """Range start clipped to a window start; ``greatest`` skips NULLs, so a
    NULL start stays NULL only when there is no window."""
    s = F.col(start).cast("date")
    if lo is None:
        return s
    return F.when(s.isNull(), F.lit(None).cast("date")).otherwise(F.greatest(s, as_date(lo)))


def clipped_end(end: str, hi=None, cap: Column | None = None) -> Column:
    """Range end clipped to window end and horizon; a NULL end means open and
    runs to the smaller of the two (``least`` skips NULLs)."""
    parts = [F.col(end).cast("date")]
    if cap is not None:
        parts.append(cap)
    if hi is not None:
        parts.append(as_date(hi))
    return parts[0] if len(parts) == 1 else F.least(*parts)


def day_of_hour(hour_start: Column, zone: str = "UTC") -> Column:
    """Calendar day an hour belongs to. Hours are zone-free UTC instants
    (``timestamp_ntz``); with another zone the day is the local day, so local
    days can hold 23 or 25 hours around DST changes."""
    if zone.upper() == "UTC":
        return F.to_date(hour_start)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), hour_start.cast("timestamp_ntz")))


def next_hour(hour_start: Column) -> Column:
    return hour_start + F.expr("INTERVAL 1 HOUR")


def day_sequence(start: Column, end: Column) -> Column:
    """Array of the days ``start..end``; call only on guarded rows
    (``start <= end``), ``sequence`` raises on inverted bounds."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def month_sequence(start: Column, end: Column) -> Column:
    """Array of the first days of all months touched by ``start..end``."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
