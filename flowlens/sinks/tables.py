"""K3 result tables and K4 cache appends (Parquet).

A write goes to a folder of its own, partitioned by kind (``TIPO``) and ``RUN_ID``; when
all of it is there, the run's manifest is replaced in one step (``sinks.manifests``).  So a
rerun replaces its run as a whole, also if it has fewer kinds or no row at all, other runs stay,
and a job that dies before that step leaves the old run as it was.  File commits go
through Spark's commit protocol, so lost executors only cost task retries.
Which runs there are, and which is the newest of a kind, is read from the manifests, not from the rows.
"""

from __future__ import annotations

import datetime as dt

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.time import ntz_literal, parse_stamp, since_literal
from flowlens.sinks.manifests import Manifests

RUN_COLUMNS = ("TS_FILTRO", "TS_CODE", "RUN_ID")


def run_id_of(run_ts) -> int:
    """Epoch milliseconds of the run stamp (UTC wall clock)."""
    stamp = parse_stamp(run_ts)
    return int(stamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def stamp_run(df: DataFrame, run_ts, since=None, row_id: bool = False) -> DataFrame:
    """Add TS_FILTRO (since, epoch ms), TS_CODE (run time) and RUN_ID (run, epoch ms).

    ``row_id`` adds ROW_ID = monotonically_increasing_id(): unique, but its
    values depend on the partitioning, so never compare it across runs.
    """
    stamp = parse_stamp(run_ts)
    cols = {
        "TS_FILTRO": F.lit(run_id_of(since) if since is not None else None).cast("bigint"),
        "TS_CODE": ntz_literal(stamp),
        "RUN_ID": F.lit(run_id_of(stamp)).cast("bigint"),
    }
    if row_id:
        cols["ROW_ID"] = F.monotonically_increasing_id()
    return df.withColumns(cols)


def write_results(df: DataFrame, path: str, partition_by=("TIPO", "RUN_ID"), metrics: dict | None = None,
                  replaces: dict | None = None, rows_per_file: int = 2_000_000, deal: bool = True) -> str:
    """K3: write a stamped result frame and publish it.

    ``partition_by`` is the kind and the columns that name a run.  ``replaces`` names the run the frame stands for
    (``{"RUN_ID": n}``, with ``TIPO`` if it is one kind only): kinds of that run which get no
    row this time are no longer part of it.  Without it each kind that has rows is replaced.
    Rows are dealt by the partition columns before the write and a file holds at most
    ``rows_per_file`` rows, so the number of files follows the data, not the
    tasks; the deal is a REBALANCE, of which Spark splits a large kind over several tasks.
    ``deal=False`` writes the rows where they are, without that shuffle: for frames whose tasks follow the
    data and hold few kinds each, like ``totals_all`` by families.
    ``metrics`` (a dict) receives ``rows`` written, observed during the
    write itself (``DataFrame.observe``) rather than by a counting job.
    """
    table = Manifests(df.sparkSession, path)
    kind, *run_by = partition_by
    schema = T.StructType([f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]).jsonValue()
    observation = Observation("written")
    df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    dealt = df.hint("rebalance", *(F.col(c) for c in partition_by)) if deal else df
    attempt = table.new_attempt()
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(f"{table.path}/{attempt}")
    try:
        rows = observation.get["rows"]
    except Py4JJavaError:  # Spark saw at planning time that there is no row, and dropped the observation
        rows = 0
    found: dict[str, dict] = {}  # run -> kind -> its folder, by the folders that were written
    for parts in table.partitions(attempt, len(partition_by)):
        run = ",".join(parts[1:])
        found.setdefault(run, {})[unquote(parts[0].split("=", 1)[1])] = {"folder": "/".join([attempt, *parts])}
    if replaces and all(c in replaces for c in run_by):
        found.setdefault(",".join(f"{c}={replaces[c]}" for c in run_by), {})
    for run, kinds in found.items():
        if not replaces:
            gone = set(kinds)
        else:
            gone = {str(replaces[kind])} if kind in replaces else None

        def change(content: dict, kinds=kinds, gone=gone) -> dict:
            kept = {} if gone is None else {k: v for k, v in content["kinds"].items() if k not in gone}
            return {"kinds": kept | kinds, "schema": schema}

        table.update(run, change)
    if metrics is not None:
        metrics["rows"] = metrics.get("rows", 0) + rows
    return path


class ResultTable:
    """A result table as its readers see it: runs by their manifests, rows by the files these name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifests = Manifests(spark, path)

    def _runs(self, since=None, run_id=None) -> list[str]:
        """Names of the runs, newest first, from one listing of folders."""
        named = sorted(((int(run.rsplit("=", 1)[1]), run) for run in self.manifests.runs()), reverse=True)
        least = None if since is None else run_id_of(since)
        wanted = None if run_id in (None, "latest") else int(run_id)
        return [run for n, run in named if (least is None or n >= least) and (wanted is None or n == wanted)]

    def runs(self, since=None) -> DataFrame:
        """(TIPO, RUN_ID) of every run not older than ``since``: a row a kind, without reading a row of the table."""
        rows = [(kind, int(run.rsplit("=", 1)[1])) for run in self._runs(since) for kind in self.manifests.newest(run)[1]["kinds"]]
        return self.spark.createDataFrame(rows, "TIPO string, RUN_ID long")

    def run(self, name: str) -> DataFrame:
        """All rows of the run of this name."""
        rows = self.manifests.frame([self.manifests.newest(name)[1]])
        if rows is None:
            raise ValueError(f"the table at {self.path} has no run {name}")
        return rows

    def read(self, tipo: str | None = None, since=None, run_id=None) -> DataFrame:
        """Rows of one kind (None: all) of the runs later than ``since``; ``run_id``: one run, or ``"latest"``, the newest of each kind.

        Manifests are read from the newest run on; with a kind given, ``"latest"`` stops at the first that has it.
        """
        contents, seen = [], set()
        for run in self._runs(since, run_id):
            content = self.manifests.newest(run)[1]
            kinds = {k: v for k, v in content["kinds"].items() if (tipo is None or k == tipo) and k not in seen}
            contents.append(content | {"kinds": kinds})
            if run_id == "latest":
                seen |= set(kinds)
                if tipo in seen:
                    break
        rows = self.manifests.frame(contents)
        if rows is None:  # no run after ``since``: the table's columns, without rows
            schemas = [self.manifests.newest(run)[1] for run in self._runs()[:1]]
            if not schemas:
                raise ValueError(f"the table at {self.path} has no run")
            rows = self.manifests.frame([schemas[0] | {"kinds": {}}])
        if tipo is not None:
            rows = rows.where(F.col("TIPO") == F.lit(tipo))
        return rows if since is None else rows.where(F.col("TS_CODE") > since_literal(rows, "TS_CODE", since))


def append_run(df: DataFrame, path: str, run_id: int, column: str = "RUN_ID") -> str:
    """K4: add the rows of one run (e.g. new IP lookups) as a partition of their own; a rerun replaces it."""
    (df.withColumn(column, F.lit(run_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    return path


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a result table; TIPO and RUN_ID come back as columns."""
    return ResultTable(spark, path).read()
