"""Helpers shared by the operators of this subpackage.

Intermediate tables go to Parquet in the folder that the session names in
``spark.checkpoint.dir`` (shared by driver and executors), so a lost
executor costs a re-read and lineage stays short.  Nothing here collects
rows of a table to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it (``stored_at``: its folder)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    (df.write if partition_by is None else df.write.partitionBy(partition_by)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame, part: str | None = None) -> None:
    """Delete the files (or those of the partition ``part``) of frames made by ``store`` that no later job reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at if part is None else f"{df.stored_at}/{part}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that ``df`` has no column of (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str):
    """The column ``name`` of any frame, dots and back-ticks in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Let the session hand Python at most ``BATCH_ROWS`` rows at once (a setting of the session, also for what comes later).

    A batch of whole texts is held by the JVM's direct memory and by the worker, and neither gives it back between stages.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def smaller(batches, rows: int = 1024):
    """The Arrow batches in slices of at most ``rows`` rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
