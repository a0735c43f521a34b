"""Time buckets and differences. Nothing here reads the clock: the reference time is an argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column

UNITS = ("SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")


def _unit(unit: str) -> str:
    name = unit.upper()
    if name not in UNITS:
        raise ValueError(f"unknown time unit {unit!r}")
    return name


def hour_bucket(ts) -> Column:
    return F.date_trunc("hour", as_column(ts))


def month_bucket(ts) -> Column:
    return F.date_trunc("month", as_column(ts))


def day_of(ts) -> Column:
    return F.to_date(as_column(ts))


def days_between(start, end) -> Column:
    """Whole calendar days from ``start`` to ``end`` (negative when reversed)."""
    return F.date_diff(as_column(end), as_column(start))


def elapsed(unit: str, start, end) -> Column:
    return F.timestamp_diff(_unit(unit), as_column(start), as_column(end))


def shift(unit: str, amount, ts) -> Column:
    quantity = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(_unit(unit), quantity, as_column(ts))


def month_name(ts) -> Column:
    return F.monthname(as_column(ts))


def day_name(ts) -> Column:
    return F.dayname(as_column(ts))
