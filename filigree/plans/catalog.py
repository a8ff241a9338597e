"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filigree.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """All tables of a folder, opened when first named."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._open: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._open:
            self._open[name] = table(self.spark, self.sf_dir, name)
        return self._open[name]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        """Register a function of ``Tables``, under its name, with the SQL that gives the same rows."""

        def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql is not None:
                self.oracles[f.__name__] = sql
            return f

        return register
