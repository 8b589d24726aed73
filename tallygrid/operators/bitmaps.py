"""Exact distinct counts at several levels from one pass over the rows, by bitmaps that merge.

A bitmap holds which of 32,768 neighbouring numbers occur. Bitmaps of a fine
level merge into those of a coarser one, so the rows are read and shuffled once,
whatever the number of levels, and a number that a group holds a thousand times
costs one bit. They suit groups with many members: each bitmap has 4 KB however
few bits are set. Where most groups are small, as in the segment profile, sums
over rows that are distinct already are cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_numbers(frame: DataFrame, column: str, stage: Callable[..., DataFrame], name: str = "number") -> DataFrame:
    """``frame`` with a number per distinct value of ``column``, for values of any type; missing values have none.

    The numbers are dense within each partition of the values, so that few
    bitmaps hold them. They follow from where a value lies, so the list is
    staged: a task that runs again must not number anew.
    """
    values = frame.select(column).dropna().distinct()
    known = stage(values.select(F.col(column).alias("_value"), F.monotonically_increasing_id().alias(name)), f"{name}s_of_{column}")
    return frame.join(known, F.col(column) == F.col("_value"), "left").drop("_value")


def bitmaps(frame: DataFrame, number: str, *keys: str) -> DataFrame:
    """One bitmap per group and bucket of numbers; ``number`` is a whole number of any size or sign."""
    held = frame.filter(F.col(number).isNotNull())
    bucket, place = F.bitmap_bucket_number(F.col(number)), F.bitmap_bit_position(F.col(number))
    return held.groupBy(*keys, bucket.alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("bitmap"))


def counts_by_level(fine: DataFrame, keys: list[str], levels: list[list[str]]) -> DataFrame:
    """Distinct numbers per group of every level, from the bitmaps of the finest.

    ``levels`` are subsets of ``keys``. A row has the level's number in the
    list, the keys of its group (others are NULL) and ``n_distinct``.
    """
    sets = [[F.col(k) for k in [*level, "_bucket"]] for level in levels]
    merged = fine.groupingSets(sets, *[F.col(k) for k in [*keys, "_bucket"]]).agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.grouping_id().alias("_set"))
    counted = merged.groupBy("_set", *keys).agg(F.sum(F.bitmap_count("bitmap")).alias("n_distinct"))
    width = len(keys) + 1
    ids = [sum(1 << (width - 1 - i) for i, k in enumerate(keys) if k not in level) for level in levels]
    level = F.array_position(F.array(*[F.lit(i).cast("long") for i in ids]), F.col("_set")) - 1
    return counted.select(level.cast("int").alias("level"), *keys, "n_distinct")
