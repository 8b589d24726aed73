"""Decorator that files a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrid.checks.mart_sql import with_ctes
from tallygrid.checks.shape import shown
from tallygrid.session import prepare
from tallygrid.sources.testtables import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Test tables by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


class Book:
    def __init__(self, extra: dict[str, str] | None = None) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}
        self.extra = extra or {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
        """File ``build`` under ``name``; without SQL only its rows are checked."""

        def file(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.queries[name] = lambda spark, sf_dir: shown(build(Tables(prepare(spark), sf_dir)))
            if sql:
                self.sql[name] = with_ctes(sql, self.extra)
            return build

        return file
