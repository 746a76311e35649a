"""Date and time semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(ts: Column | str) -> Column:
    """``YYYYMMDD`` integer key of a date/timestamp; NULL stays NULL.

    Integer arithmetic on the wall-clock date fields: no string formatting
    per row, and independent of the session time zone.
    """
    d = _c(ts).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of midnights crossed from ``start`` to ``end``.

    23:59 -> 00:01 is one day, unlike elapsed-time ``timestampdiff``.
    """
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def hour_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end``.

    10:59 -> 11:01 is one hour, unlike elapsed-time ``timestampdiff``.
    Computed from wall-clock fields (24 per midnight crossed, plus the hour
    difference), so it does not depend on the session time zone.
    """
    s, e = _c(start), _c(end)
    return (day_boundaries(s, e) * 24 + F.hour(e) - F.hour(s)).cast("int")


def day_of_week_sunday0(d: Column | str) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def padded_name(d: Column | str, pattern: str, width: int = 9) -> Column:
    """Full day/month name blank-padded to ``width`` characters."""
    return F.rpad(F.date_format(_c(d), pattern), width, " ")


def strict_greatest(*cols: Column) -> Column:
    """``GREATEST`` that is NULL when any argument is NULL.

    Spark's ``greatest`` skips NULLs; the warehouse dialect does not.
    """
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cols))
