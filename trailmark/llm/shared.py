"""Helpers that every operator of this subpackage uses: shared tables and tokenizer paths."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting to remove shuffle files once a query is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine (tests), a temporary one is made and
    set; a cluster without one is an error, for its executors would write where no one else reads.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="trailmark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, *, release: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    It cuts the lineage in a way that survives the loss of executors, and gives later joins
    plain exchanges on both sides, which adaptive execution can split where a key is hot.
    These tables stay until the folder is cleared, so they are compressed well. With ``release``,
    Spark removes the shuffle files behind the table as soon as it is written; ``df`` is not to be
    used again then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true" if release else before)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear(table: DataFrame) -> None:
    """Empty a table that ``stage`` wrote and nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)


def row_number(column: str | None) -> Column:
    """A number of its own for each row: that of ``column``, if one is named."""
    return F.col(column) if column else F.monotonically_increasing_id()


def tokenizer_path(name: str) -> str:
    """Resolve a tokenizer file: a path stays as it is, a bare name is looked up on this machine."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
