"""Date arithmetic on billing periods and months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels for open service periods.
OPEN_START = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)


def service_start(day: Column) -> Column:
    return F.coalesce(day, F.lit(OPEN_START))


def service_end(day: Column) -> Column:
    return F.coalesce(day, F.lit(OPEN_END))


def month_first(day: Column) -> Column:
    return F.trunc(day, "MM")


def inclusive_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + F.lit(1)


def representative_month(start: Column, end: Column) -> Column:
    """Month two thirds into the period, the offset cut to whole days."""
    offset = (inclusive_days(start, end) * F.lit(2 / 3)).cast("int")
    return F.month(F.date_add(start, offset))


def overlap_days(month_start: Column, month_end: Column, start: Column, end: Column) -> Column:
    """Days shared by a month and a closed period."""
    return inclusive_days(F.greatest(month_start, start), F.least(month_end, end))


def open_period_days(month_start: Column, month_end: Column, service_to: Column, billed_to: Column) -> Column:
    """Days of the month in service but after the last billed day; may be zero or less."""
    return overlap_days(month_start, month_end, F.date_add(billed_to, 1), service_to)
