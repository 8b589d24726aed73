"""Discount amounts and their daily shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrid.functions.calendar import inclusive_days
from tallygrid.functions.numeric import per_day

# Adjustment types that carry guaranteed discounts, and the tax share.
GUARANTEED_TYPES = ("USAGE_DISC", "USAGE_DISCCR", "GD", "GD_REV")
PAY_ON_TIME_PATTERN = "DISCOUNT%"
# Label, code for electricity, code otherwise.
GUARANTEED = ("Discount - Guaranteed", "DIS_SUPPLY", "DIS")
ELIGIBLE = ("Discount - Eligible PPD", "EPPD_SUPPL", "EPPD")
PAID = ("Discount - PPD", "PPD_SUPPLY", "PPD")


def before_tax(amount: Column) -> Column:
    """Ten elevenths of a tax-inclusive amount."""
    return amount / F.lit(11).cast("decimal(2,0)") * F.lit(10).cast("decimal(2,0)")


def strip_tax(net: Column, tax: Column) -> Column:
    """Lines without a tax amount hold the tax inside their net amount."""
    return (
        F.when((tax == 0) & (net != 0), before_tax(net))
        .when((tax != 0) & (net != 0), net)
        .otherwise(F.lit(0))
    )


def rounded_discount(total: Column) -> Column:
    """Three decimals, ties to even, as a number format would print it."""
    return F.bround(before_tax(total), 3)


def formatted_discount(total: Column) -> Column:
    return F.call_function("format_number", before_tax(total), F.lit("0.000"))


def discount_code(kind: tuple[str, str, str], fuel: Column) -> Column:
    _, electricity, other = kind
    return F.when(fuel == "ELECTRICITY", electricity).otherwise(other)


def daily_discount(code: Column, pattern: str, sign: int, amount: Column, start: Column, end: Column) -> Column:
    """Daily share of a discount whose code fits ``pattern``; NULL for periods of one day."""
    spread = per_day(amount, inclusive_days(start, end))
    applies = (F.datediff(end, start) > 0) & code.like(pattern)
    return F.when(applies, spread if sign > 0 else -spread)
