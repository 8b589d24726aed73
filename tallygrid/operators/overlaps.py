"""Joins of closed periods with the months they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.calendar import month_first
from tallygrid.params import MonthRange


def overlap_join(periods: DataFrame, horizon: DataFrame, months: MonthRange, start: Column, end: Column) -> DataFrame:
    """Range-condition form: every period is compared with every month. Spark chooses the join by the measured sizes."""
    return periods.join(horizon, (start <= F.col("mth_edt")) & (end >= F.col("mth_sdt")))


def cross_overlap(periods: DataFrame, horizon: DataFrame, months: MonthRange, start: Column, end: Column) -> DataFrame:
    """Product-and-filter spelling; the optimizer turns it into the range-condition join."""
    return periods.crossJoin(horizon).filter((start <= F.col("mth_edt")) & (end >= F.col("mth_sdt")))


def overlap_explode(
    periods: DataFrame, horizon: DataFrame, months: MonthRange, start: Column, end: Column
) -> DataFrame:
    """Equal-key form: a period yields only the months it touches, clamped to the horizon.

    Work per period follows its length, not the length of the horizon, and open
    end dates cost no more than the horizon. This is the form the plans use.
    """
    spread = months_touched(periods, months, start, end, "_month")
    return spread.join(horizon, F.col("_month") == F.col("mth_sdt")).drop("_month")


def _bounds(months: MonthRange, start: Column, end: Column) -> tuple[Column, Column]:
    return F.greatest(month_first(start), F.lit(months.first)), F.least(month_first(end), F.lit(months.last))


def touches(months: MonthRange, start: Column, end: Column) -> Column:
    """Whether a period has a row in :func:`months_touched`; never NULL."""
    first, last = _bounds(months, start, end)
    return start.isNotNull() & end.isNotNull() & (first <= last)


def months_touched(periods: DataFrame, months: MonthRange, start: Column, end: Column, name: str = "mth_sdt") -> DataFrame:
    """A row per period and month of ``months`` that it touches, with the month's first day."""
    touched = F.when(touches(months, start, end), F.sequence(*_bounds(months, start, end), F.expr("interval 1 month")))
    return periods.select("*", F.explode(touched).alias(name))


def in_horizon(monthly: DataFrame, horizon: DataFrame) -> DataFrame:
    """Rows of :func:`months_touched` in the months of ``horizon``.

    If ``monthly`` is stored in partitions by month, the horizon's months are
    looked up at run time and only their files are read: several horizons can
    share one stored frame, and a period counts in each month it touches.
    """
    return monthly.join(horizon, "mth_sdt")
