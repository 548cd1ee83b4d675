"""Columns for half-open validity windows [from, to), null = unbounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_PAST, FAR_FUTURE = "0001-01-01", "9999-12-31"


def valid_at(time: Column, start: Column, end: Column) -> Column:
    """True where `time` lies in [start, end). Dates count as their midnight."""
    return (start.isNull() | (start <= time)) & (end.isNull() | (end > time))


def overlaps(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    """True where two windows share an instant."""
    return (a_to.isNull() | b_from.isNull() | (b_from < a_to)) & (b_to.isNull() | a_from.isNull() | (a_from < b_to))


def lower(start: Column) -> Column:
    return F.coalesce(start, F.lit(FAR_PAST).cast("date"))


def upper(end: Column) -> Column:
    return F.coalesce(end, F.lit(FAR_FUTURE).cast("date"))


def month_of(time: Column) -> Column:
    """Month key YYYY-MM."""
    return F.date_format(time, "yyyy-MM")
