"""Segment key shared by bills, profiles and accounts without bills."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def segment_hash(
    month: Column,
    sub_region: Column | str = "market_sub_region",
    fuel: Column | str = "fuel_type",
    region: Column | str = "market_region",
    segment: Column | str = "customer_segment",
) -> Column:
    """MD5 of the joined segment parts; NULL as soon as one part is NULL."""
    parts = [part if isinstance(part, Column) else F.col(part) for part in (sub_region, fuel, region, segment)]
    return F.md5(F.concat(month.cast("string"), *parts))
