"""Sinks: append tables, latest-row tables and snapshots."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import latest


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); on one machine that names none, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="trailmark-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def append(stream: DataFrame, path: str, checkpoint: str, *, partition_by: list[str] | None = None, period: str | None = None):
    """A live topic as an append-only Parquet table."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    return writer.trigger(processingTime=period).start() if period else writer.trigger(availableNow=True).start()


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a retained table that are written whole, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    done = [int(n.split("=")[1]) for n in names if n.startswith("version=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(done)


def retained(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The current rows of a retained table, or those before a version; None where there are none."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/version={known[-1]}") if known else None


def retain(by: list[str], path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: a retained topic, the last row of each key, as a table in versions.

    A batch writes a version of its own from the one before and never touches what readers read; a
    batch that comes again writes the same one. Old versions are left to the folder's retention.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        old = retained(batch.sparkSession, path, before=number)
        latest(batch if old is None else old.unionByName(batch), by).write.mode("overwrite").parquet(f"{path}/version={number}")

    return upsert


def topic(spark: SparkSession, path: str, schema: str, *, channels: list[str] | None = None, stream: bool = False, most_files: int | None = None) -> DataFrame:
    """A topic table written by :func:`append`, at rest or as a stream; channels are pruned as partitions."""
    reader = (spark.readStream if stream else spark.read).schema(schema)
    if stream and most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    rows = reader.parquet(path)
    return rows.where(F.col("channel").isin(channels)) if channels else rows
