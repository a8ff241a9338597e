"""Standard metrics out of concepts: mapping by priority, gated by confidence, with a history per company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEYS = ["owner", "fiscal_year", "fiscal_quarter", "metric_id"]


def normalize(facts: DataFrame, mappings: DataFrame) -> DataFrame:
    """(owner, fiscal_year, fiscal_quarter, metric_id, metric_value, source_concept, confidence): the value of the mapped concept of highest priority.

    ``facts`` has (owner, concept_name, value, fiscal_year, fiscal_quarter, id),
    a null quarter meaning the year; ``mappings`` has (metric_id, concept_name,
    priority, confidence), a small table that joins by broadcast when it is.
    """
    rows = facts.where("value is not null").join(mappings, "concept_name")
    best = Window.partitionBy(*KEYS).orderBy("priority", F.desc("confidence"), F.desc("id"))
    rows = rows.withColumn("n", F.row_number().over(best)).where("n = 1")
    return rows.select(*KEYS, F.col("value").alias("metric_value"), F.col("concept_name").alias("source_concept"), "confidence")


def lookup(normalized: DataFrame, owner: str | None = None, year: int | None = None, metric: str | None = None) -> DataFrame:
    """Rows by any of the filters that are given."""
    for column, value in (("owner", owner), ("fiscal_year", year), ("metric_id", metric)):
        if value:
            normalized = normalized.where(F.col(column) == value)
    return normalized.orderBy("owner", F.desc("fiscal_year"), "metric_id")


def compare(normalized: DataFrame, owners: DataFrame, metric: str) -> DataFrame:
    """(owner, fiscal_year, metric_value): the latest value of a metric for every requested owner, null for those without."""
    own = normalized.where((F.col("metric_id") == metric) & F.col("metric_value").isNotNull())
    last = own.withColumn("n", F.row_number().over(Window.partitionBy("owner").orderBy(F.desc("fiscal_year"), F.col("fiscal_quarter").desc_nulls_first()))).where("n = 1")
    return owners.select("owner").distinct().join(last.select("owner", "fiscal_year", "metric_value"), "owner", "left")
