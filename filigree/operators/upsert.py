"""Table changes as set operations: each gives the new content of a table, to be written to a staging folder and swapped.

Keys compare null-safe. Of several new rows with one key the last by ``order`` counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], overwrite: list[str] = (), keep_known: list[str] = (), stamp: dict[str, Column] | None = None) -> DataFrame:
    """Full merge: ``overwrite`` columns take the new value, ``keep_known`` the new one unless it is null, others keep the old.

    ``new`` has at most one row per key. ``stamp`` sets columns of rows that ``new`` touches.
    """
    a, b = old.alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    joined = a.withColumn("_old", F.lit(True)).alias("a").join(b, reduce(Column.__and__, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]), "full_outer")
    fresh, touched = F.col("a._old").isNull(), F.col("b._new").isNotNull()
    out = []
    for c in old.columns:
        x, y = F.col(f"a.{c}"), (F.col(f"b.{c}") if c in new.columns else F.lit(None).cast(old.schema[c].dataType))
        if c in keys:
            value = F.when(fresh, y).otherwise(x)
        elif stamp and c in stamp:
            value = F.when(touched, stamp[c]).otherwise(x)
        elif c in overwrite:
            value = F.when(touched, y).otherwise(x)
        elif c in keep_known:
            value = F.coalesce(y, x)
        else:
            value = F.when(fresh, y).otherwise(x)
        out.append(value.alias(c))
    return joined.select(*out)


def patch(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Partial update by key: columns of ``changes`` that are not null replace the old ones; unknown keys add nothing."""
    given = [c for c in changes.columns if c not in keys]
    b = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_v_{c}") for c in given])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return old.join(b, on, "left").select(*[F.coalesce(f"_v_{c}", c).alias(c) if c in given else F.col(c) for c in old.columns])


def absent(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows of ``new`` to append: the first of each key that ``old`` does not have."""
    first = latest(new, keys, order)
    return first.join(old, _same(first, old, keys), "left_anti")


def gated(old: DataFrame, new: DataFrame, keys: list[str], confidence: str, order: str) -> DataFrame:
    """Merge in which a row gives way only to one of at least its confidence; among equals the later by ``order`` stays."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return latest(rows, keys, [F.col(confidence).desc_nulls_last(), F.col("_new").desc(), F.col(order).desc_nulls_last()]).drop("_new")


def replaced(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Delete and insert: all old rows of the ``by`` values that ``new`` holds go, the new rows come."""
    gone = new.select(*by).distinct()
    return old.join(gone, _same(old, gone, by), "left_anti").unionByName(new)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def without_duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(rows kept, counts of a dry run: groups, rows to delete)."""
    counts = duplicate_groups(df, keys).agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_to_delete"))
    return latest(df, keys, order), counts
