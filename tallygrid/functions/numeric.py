"""Exact decimal arithmetic for per-day values.

Money and volumes stay decimal so that sums do not depend on task order. The
casts fix the scale of each step; without them Spark widens decimal(18,4)
inputs to precision 38 and cuts the fraction to six digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

RATE = DecimalType(28, 15)
DAYS = DecimalType(7, 0)
AMOUNT = DecimalType(24, 9)
AVERAGE = DecimalType(20, 5)
DIVISOR = DecimalType(20, 10)
# Quotients of averages below this fit thirteen digits after the point.
RATIO_LIMIT = 1e9


def null_rate() -> Column:
    return F.lit(None).cast(RATE)


def zero_rate() -> Column:
    return F.lit(0).cast(RATE)


def per_day(amount: Column, days: Column) -> Column:
    return (amount.cast(AMOUNT) / days.cast(DAYS)).cast(RATE)


def over_days(rate: Column, days: Column) -> Column:
    return (rate.cast(RATE) * days.cast(DAYS)).cast(RATE)


def times(left: Column, right: Column) -> Column:
    return (left * right).cast(RATE)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient of two averages, NULL for a zero divisor."""
    return F.try_divide(part.cast(AVERAGE), whole.cast(DIVISOR)).cast(DecimalType(23, 13))


def share(part: Column, whole: Column) -> Column:
    """Quotient of two counts, NULL for a zero divisor."""
    count = DecimalType(18, 0)
    return F.try_divide(part.cast(count), whole.cast(count)).cast(DecimalType(20, 15))
