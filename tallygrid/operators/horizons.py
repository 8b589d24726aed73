"""Day calendar and month horizons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.params import MonthRange, RunParams

def day_calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.trunc("date", "MM").alias("first_day_month"),
        F.last_day("date").alias("last_day_month"),
    )


def calendar_between(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return day_calendar(bounds)


def months_in(calendar: DataFrame, months: MonthRange) -> DataFrame:
    """Distinct months of ``calendar`` whose first day lies in the closed range."""
    first_day = F.trunc("date", "MM")
    return (
        calendar.filter(first_day.between(F.lit(months.first), F.lit(months.last)))
        .select(
            "year",
            F.col("month").alias("mth_no"),
            F.col("first_day_month").alias("mth_sdt"),
            F.col("last_day_month").alias("mth_edt"),
            F.dayofmonth(F.last_day("date")).alias("mth_days"),
        )
        .distinct()
    )


def month_horizon(calendar: DataFrame, params: RunParams) -> DataFrame:
    """Months the accrual is reported for."""
    return months_in(calendar, params.accrual_range)


def trailing_horizon(calendar: DataFrame, params: RunParams) -> DataFrame:
    """Months the seasonal profile is taken from."""
    return months_in(calendar, params.seasonal_range)
