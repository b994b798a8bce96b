"""The ingest-time high-water mark (``TS_CODE > since``) as a streaming query.

The batch jobs select new rows with a stamp kept by hand.  Here the LOG
table's file source does that bookkeeping: the query's checkpoint records
which files were processed, so each trigger sees only new files.  Every
micro-batch computes the 21 totals over its rows and writes them to the
table ``LOG_TOTAIS_STREAM``, apart from the batch jobs' runs, partitioned by TIPO, QUERY_ID (the id
that the checkpoint keeps for the query, so a new checkpoint never meets an
old one's batches) and RUN_ID = batch id.  ``foreachBatch``
may replay a batch after a failure; the replay publishes that batch's
run anew, so output counts once.

Like the batch job, each run's totals cover that run's rows only.  With ``merge`` every
micro-batch is also added to the all-time totals ``LOG_TOTAIS_STREAM_ALL``, once, however often it is replayed.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import totals as TOT
from flowlens.schemas import LOG_SCHEMA
from flowlens.sinks.state import TotalsState
from flowlens.sinks.tables import ResultTable, stamp_run, write_results
from flowlens.sources import scans


STREAM_TABLE = "LOG_TOTAIS_STREAM"
QUERY_ID = "sql.streaming.queryId"


def _write_batch(tables_dir: str, strategy: str, merge: bool = False):
    path = os.path.join(tables_dir, STREAM_TABLE)

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        conn = scans.scan_conn(batch).persist()  # read by both levels of the totals
        try:
            stamp = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            res = stamp_run(TOT.totals_all(conn, strategy=strategy), stamp)
            res = res.withColumns({"RUN_ID": F.lit(batch_id).cast("bigint"), "QUERY_ID": F.lit(query)})
            write_results(res, path, partition_by=("TIPO", "QUERY_ID", "RUN_ID"),
                          replaces={"QUERY_ID": query, "RUN_ID": batch_id})
            if merge:
                run, spark = f"QUERY_ID={query},RUN_ID={batch_id}", batch.sparkSession
                TotalsState(spark, path + "_ALL").merge(ResultTable(spark, path).run(run), run)
        finally:
            conn.unpersist()

    return run


def incremental_totals(spark: SparkSession, log_path: str, tables_dir: str, checkpoint: str,
                       schema=LOG_SCHEMA, strategy: str = "grouping_sets", max_files_per_trigger: int | None = None,
                       available_now: bool = True, merge: bool = False):
    """Start the streaming totals query; returns the StreamingQuery.

    ``checkpoint`` must be on shared storage (it is the high-water mark).
    ``available_now`` processes what is there and stops; otherwise the
    query keeps running and picks up new files as they land.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(log_path)
    writer = stream.writeStream.foreachBatch(_write_batch(tables_dir, strategy, merge)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental_totals(spark: SparkSession, log_path: str, tables_dir: str, checkpoint: str, **kw) -> None:
    """Process every file not yet seen, then return."""
    q = incremental_totals(spark, log_path, tables_dir, checkpoint, available_now=True, **kw)
    q.awaitTermination()
