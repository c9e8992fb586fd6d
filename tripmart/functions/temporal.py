"""Calendar expressions for trips (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def week_id(ts: Column) -> Column:
    """Calendar year plus ISO week, ``2025-W02``. 2024-12-30 gives ``2024-W01``.

    Same text as ``format_string('%04d-W%02d', year, week)``; for years 0-9999 it is
    built with ``lpad``, which avoids a ``java.util.Formatter`` call per trip. Other
    years and a NULL time (``null-Wnull``) go through ``format_string``.
    """
    y, w = F.year(ts), F.weekofyear(ts)
    fast = F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-W"), F.lpad(w.cast("string"), 2, "0"))
    return F.when(y.between(0, 9999), fast).otherwise(F.format_string(S.WEEK_ID_FORMAT, y, w))


def week_start(ts: Column) -> Column:
    """Monday of the ISO week, as a date: counted back in whole days, without a second turn through the time zone."""
    day = F.to_date(ts)
    return F.date_sub(day, F.weekday(day))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole epoch seconds apart / 60; a negative span is NULL."""
    m = (end.cast("long") - start.cast("long")) / 60.0
    return F.when(m < 0, F.lit(None).cast("double")).otherwise(m)


def in_hour_ranges(hour: Column, ranges: list[tuple[int, int]]) -> Column:
    """Hour inside any of the inclusive ranges."""
    out = None
    for lo, hi in ranges:
        p = hour.between(lo, hi)
        out = p if out is None else (out | p)
    return out if out is not None else F.lit(False)
