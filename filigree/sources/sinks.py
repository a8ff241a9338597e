"""Writers that can be run again: partitions written once, appended logs, graphs and vector collections as folders of Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _held(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where there is none yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if files.exists(at) else None


def write_new(df: DataFrame, path: str, keys: list[str], force: bool = False, partition_by: list[str] | None = None) -> int:
    """Append the rows whose keys are not there yet (all rows, replacing the table, if forced); the number written."""
    held = None if force else _held(df.sparkSession, path)
    if held is not None:
        df = df.join(held.select(*keys).distinct(), keys, "left_anti")
    n = df.count()
    if n or held is None:
        writer = df.write.mode("overwrite" if force or held is None else "append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return n


def append_log(spark: SparkSession, path: str, stage: str, status: str, context: dict[str, str] | None = None, **counts: int) -> None:
    """One line of the processing log, the context as JSON."""
    pairs = [x for k, v in sorted((context or {}).items()) for x in (F.lit(k), F.lit(v))]
    as_json: Column = F.to_json(F.create_map(*pairs)) if pairs else F.lit(None).cast("string")
    line = spark.range(1).select(
        F.lit(stage).alias("pipeline_stage"), F.lit(status).alias("status"), F.current_timestamp().alias("created_at"), F.lit(counts.get("processed")).cast("int").alias("records_processed"), F.lit(counts.get("failed")).cast("int").alias("records_failed"), as_json.alias("context")
    )
    line.coalesce(1).write.mode("append").parquet(path)


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes once by id, edges once by end points and type; of several the greatest row stays."""
    rest = [c for c in edges.columns if c not in ("src", "dst", "type")]
    once = edges.groupBy("src", "dst", "type").agg(*[F.max_by(c, F.struct(*rest)).alias(c) for c in rest]) if rest else edges.distinct()
    nodes.dropDuplicates(["id"]).write.mode("overwrite").parquet(f"{path}/nodes")
    once.write.mode("overwrite").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def upsert_vectors(points: DataFrame, path: str, dim: int, force: bool = False) -> int:
    """Points (id, embedding, payload...) into a collection of one dimension, the new row of an id replacing the old; the number held. Points of another dimension are refused."""
    if points.where((F.size("embedding") != dim) | F.col("embedding").isNull()).limit(1).count():
        raise ValueError(f"vectors must have {dim} values")
    spark = points.sparkSession
    held = None if force else _held(spark, path)
    if held is not None:
        held = held.join(points.select("id"), "id", "left_anti")
        points = reduce(DataFrame.unionByName, [held, points.dropDuplicates(["id"])])
    else:
        points = points.dropDuplicates(["id"])
    # written beside and read from there, as a table cannot be read while it is overwritten
    points.write.mode("overwrite").parquet(f"{path}.next")
    done = spark.read.parquet(f"{path}.next")
    done.write.mode("overwrite").parquet(path)
    return done.count()
