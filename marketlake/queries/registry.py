"""Collects queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.queries import inputs

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Derived and given tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return inputs.frame(*self._at, name)


class Group:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, make: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        """A query over the tables, and the SQL that gives the same rows."""
        self.queries[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql is not None:
            self.sql[name] = inputs.sql(sql)

    def add_spark(self, name: str, make: Callable[[SparkSession, Tables], DataFrame], sql: str | None = None) -> None:
        """The same for queries that need the session, to write and read files."""
        self.queries[name] = lambda spark, sf_dir: make(spark, Tables(spark, sf_dir))
        if sql is not None:
            self.sql[name] = inputs.sql(sql)
