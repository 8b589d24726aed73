"""Data tests; each returns the violations, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(frame: DataFrame, *columns: str) -> DataFrame:
    """Non-null values (or combinations) that occur more than once."""
    counted = frame.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter("n_records > 1")


def not_null(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull())


def accepted_values(frame: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    outside = frame.filter(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def custom_query(frame: DataFrame, violations: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return violations(frame)


def passes(violations: DataFrame) -> bool:
    return violations.isEmpty()
