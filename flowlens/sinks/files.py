"""K1 CSV and K2 JSON writers.

By default the output is one file per task.  ``order`` sorts globally
(range partitioning, so part files are in order and the sort is
parallel).  ``single_file`` funnels the result through one task and is
meant for small, already-aggregated exports only.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _prepare(df: DataFrame, order, single_file: bool, drop=()) -> DataFrame:
    """Sort for writing; the sort is the last step before the writer.

    With ``single_file`` the rows go to one partition first and are sorted
    there (a shuffle does not keep an earlier order).  ``drop`` removes
    sort-only columns after sorting, which keeps the row order.
    """
    if single_file:
        df = df.repartition(1)
        df = df.sortWithinPartitions(*order) if order else df
    elif order:
        df = df.orderBy(*order)
    return df.drop(*drop) if drop else df


def write_csv(df: DataFrame, path: str, order=None, single_file: bool = False, mode: str = "overwrite",
              drop=()) -> str:
    """K1: CSV with a header line; replaces ``path``."""
    _prepare(df, order, single_file, drop).write.mode(mode).option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str, order=None, single_file: bool = False, mode: str = "overwrite",
               drop=()) -> str:
    """K2: JSON lines; replaces ``path``."""
    _prepare(df, order, single_file, drop).write.mode(mode).json(path)
    return path


def write_parts(df: DataFrame, out_dir: str, by: str, name, order, fmt: str = "csv", single_file: bool = False, drop=(),
                expected=()) -> list[str]:
    """One export folder for each value of ``by``, all in one write job; returns their paths.

    One sort by ranges of (``by``, ``order``), written with a folder a value: a small value is one file, a large one
    several, in order.  The job writes to a folder beside the exports; each value's folder is then
    moved to ``out_dir``/``name(value)``, where it replaces an older one.  ``name`` takes the value as text.  Exports of
    ``expected`` values that get no row are removed.  Rows without a value are not exported; the column stays in them.
    """
    spark = df.sparkSession
    folder = "_part"
    rows = df.where(F.col(by).isNotNull()).withColumn(folder, F.col(by).cast("string"))
    keys = [F.col(folder), *order]
    rows = (rows.repartition(folder) if single_file else rows.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    staged = f"{out_dir.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    rows.drop(*drop).write.partitionBy(folder).option("header", True).format(fmt).save(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {unquote(s.getPath().getName().split("=", 1)[1]): s.getPath() for s in fs.globStatus(path(f"{staged}/{folder}=*")) or []}
    out = []
    for value in sorted({*found, *expected}):
        target = path(f"{out_dir.rstrip('/')}/{name(value)}")
        fs.delete(target, True)
        if value in found:
            fs.rename(found[value], target)
            out.append(target.toString())
    fs.delete(path(staged), True)
    return out
