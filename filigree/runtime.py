"""Session set-up, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one Arrow batch may carry to a Python worker, so that a
#: batch of very long texts stays small whatever the number of its rows.
ARROW_BATCH_BYTES = 16 * 1024 * 1024


def local_session(app: str = "filigree", cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as texts vary from nothing to megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Only where that setting is absent, as in tests on one machine, is a
    temporary folder made; a cluster without the setting is refused.
    """
    said = spark.conf.get("spark.checkpoint.dir", None)
    if said:
        return said.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="filigree-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return f"file://{_own_dirs[app]}"


def stage(df: DataFrame, *, label: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Unlike a checkpoint of rows the written table is columnar and compressed,
    later reads prune its columns, and its size is known to the optimizer.
    It survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/filigree-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what ``stage`` wrote in this application; earlier results that still read it become invalid."""
    url = urlparse(f"{shared_dir(spark)}/filigree-{spark.sparkContext.applicationId}")
    if url.scheme in ("", "file"):
        shutil.rmtree(Path(url.path), ignore_errors=True)
    else:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(url.geturl())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after the row count has been checked against ``max_rows``; else leave the join to the optimizer."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def dashed_accession(col: Column) -> Column:
    """Accession numbers in the form 10-2-6; anything else stays as it stands."""
    return F.regexp_replace(F.trim(col), r"^(\d{10})-?(\d{2})-?(\d{6})$", "$1-$2-$3")


def plain_accession(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), "-", "")


def padded_cik(col: Column) -> Column:
    """Ten digits with leading zeros; null for anything that is not a number of one to ten digits."""
    bare = F.regexp_extract(F.trim(col), r"^0*(\d{1,10})$", 1)
    return F.when(bare != "", F.lpad(bare, 10, "0"))
