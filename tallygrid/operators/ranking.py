"""Ranks of bills within an account."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_dense_ranks(rows: DataFrame, key: str, ranks: dict[str, str]) -> DataFrame:
    """Add ``{column: rank}`` dense ranks, latest first, within ``key``.

    A dense rank depends on the distinct values only. The window therefore runs
    over the distinct value combinations per key, which the calendar bounds, and
    the ranks are joined back on the full combination. A key that owns a large
    share of all rows never meets in one task.
    """
    columns = [key, *ranks]
    combos = rows.select(*columns).distinct()
    for column, rank in ranks.items():
        latest_first = Window.partitionBy(key).orderBy(F.col(column).desc())
        combos = combos.withColumn(rank, F.dense_rank().over(latest_first))
    renamed = combos.select(*[F.col(c).alias(f"_{c}") for c in columns], *ranks.values())
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return rows.join(renamed, same).drop(*[f"_{c}" for c in columns])


def ranks_in_buckets(rows: DataFrame, key: str, ranks: dict[str, str]) -> DataFrame:
    """The rows of :func:`with_dense_ranks` in one pass: windows over the rows themselves, dealt once by ``key``.

    Nothing is read twice and no wide row travels to a join. All rows of a key
    meet in one task: bound them first (:func:`tallygrid.operators.skew.fits_buckets`).
    """
    own = Window.partitionBy(key)
    return rows.select("*", *[F.dense_rank().over(own.orderBy(F.col(c).desc())).alias(rank) for c, rank in ranks.items()])


def latest_by_maxima(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """Rows that rank first within ``key`` in any of ``columns``; the same rows as ranks would give, without a window.

    Maxima combine before the shuffle. A missing value is first only where the key has no other.
    """
    latest = rows.groupBy(F.col(key).alias("_key")).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    joined = rows.join(latest, F.col(key).eqNullSafe(F.col("_key")))
    first: Column = reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return joined.filter(first).drop("_key", *[f"_{c}" for c in columns])


def latest_in_buckets(rows: DataFrame, key: str, *columns: str, also: Column | None = None) -> DataFrame:
    """The rows of :func:`latest_by_maxima` in one pass, and those that fit ``also``, for frames that are dealt by ``key``.

    The maxima come from a window over the key, so nothing is read twice or
    joined, and a frame in buckets of ``key`` is not exchanged. All rows of a key
    meet in one task: bound them first (:func:`tallygrid.operators.skew.fits_buckets`).
    """
    own = Window.partitionBy(key)
    ranked = rows.select("*", *[F.max(c).over(own).alias(f"_{c}") for c in columns])
    first: Column = reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return ranked.filter(first if also is None else first | also).drop(*[f"_{c}" for c in columns])


def latest_with_ties(rows: DataFrame, *ranks: str) -> DataFrame:
    """Rows ranked first in any of the orders; ties stay."""
    first: Column = reduce(lambda a, b: a | b, [F.col(rank) == 1 for rank in ranks])
    return rows.filter(first)
