"""All queries of the core by name, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filigree.plans import documents, facts_wide, files, passages, quality, relational, search, tools

MODULES = [documents, facts_wide, files, passages, quality, relational, search, tools]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
