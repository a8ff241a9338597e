"""Incremental work as streams: files once each, windows over event time, sessions, and idempotent sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filigree.runtime import shared_dir


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """A stream over Parquet files that appear in a folder; each is read once, as the checkpoint remembers."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def drain(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Work off all that is there and stop: the next call goes on where this one ended."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()


def drain_into(stream: DataFrame, checkpoint: str, sink) -> None:
    """As ``drain`` with a function of (batch, number) as sink; give it keys to merge by, as a batch may come twice."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/filigree-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def windowed(events: DataFrame, time: str, by: list[str], length: str, late: str | None = "1 hour", slide: str | None = None, value: str | None = None) -> DataFrame:
    """(window_start, by..., n[, total]): counts by tumbling or sliding windows; the same for a table and, with ``late``, for a stream."""
    rows = events.withWatermark(time, late) if events.isStreaming and late else events
    span = F.window(time, length, slide) if slide else F.window(time, length)
    measures: list[Column] = [F.count("*").alias("n")]
    if value:
        measures.append(F.sum(value).alias("total"))
    return rows.groupBy(span.alias("w"), *by).agg(*measures).select(F.col("w.start").alias("window_start"), *by, "n", *(["total"] if value else []))


def sessions(events: DataFrame, time: str, by: list[str], gap: str, late: str | None = "1 hour") -> DataFrame:
    """(session_start, session_end, by..., n): events of a key with pauses under ``gap``."""
    rows = events.withWatermark(time, late) if events.isStreaming and late else events
    return rows.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")
