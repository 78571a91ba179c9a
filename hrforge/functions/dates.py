"""Date helpers expressed as built-in column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(d) -> Column:
    """A literal DATE column from a ``datetime.date`` or ISO string."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d).cast("date")


def to_date_value(d) -> _dt.date:
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


def month_start(d) -> _dt.date:
    d = to_date_value(d)
    return d.replace(day=1)


def next_month_start(d) -> _dt.date:
    d = month_start(d)
    return (d.replace(year=d.year + 1, month=1) if d.month == 12
            else d.replace(month=d.month + 1))


def month_end(d) -> _dt.date:
    return next_month_start(d) - _dt.timedelta(days=1)


def prev_month_start(d) -> _dt.date:
    d = month_start(d)
    return d.replace(year=d.year - 1, month=12) if d.month == 1 else d.replace(month=d.month - 1)


def in_month(col: Column, as_of) -> Column:
    """``MONTH(col)=MONTH(as_of) AND YEAR(col)=YEAR(as_of)`` written as a date range
    so parquet row groups and date partitions can be pruned."""
    return (col >= F.lit(month_start(as_of))) & (col < F.lit(next_month_start(as_of)))


def weekday_name(col: Column) -> Column:
    """English weekday name (``Friday``), compared case-blind by callers."""
    return F.date_format(col, "EEEE")


def later_date(d1: Column, d2: Column) -> Column:
    """``CASE WHEN d1 >= d2 THEN d1 ELSE d2``: a null in d1 gives d2, a null in d2
    gives null (``greatest`` would skip nulls, which is different)."""
    return F.when(d1 >= d2, d1).otherwise(d2)


def earlier_date(d1: Column, d2: Column) -> Column:
    """``CASE WHEN d1 <= d2 THEN d1 ELSE d2``."""
    return F.when(d1 <= d2, d1).otherwise(d2)


def overlaps(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> Column:
    """The four-way BETWEEN overlap test used by the leave checks, kept in the same
    boolean form so nulls behave the same (a null end date still matches on the
    start)."""
    return (from_a.between(from_b, to_b) | to_a.between(from_b, to_b)
            | from_b.between(from_a, to_a) | to_b.between(from_a, to_a))


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def duration_minutes(check_in: Column, check_out: Column) -> Column:
    """``DATEDIFF(minute, in, out)`` counts minute boundaries crossed
    (10:00:59 -> 10:01:00 is 1), so subtract minute-of-day values rather than use
    ``timestampdiff`` (which would give 0 there)."""
    return (minute_of_day(check_out) - minute_of_day(check_in)).cast("int")
