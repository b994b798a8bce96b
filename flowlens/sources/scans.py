"""S2-S6 scans and P1-P3 record views.

Every scan is a filter on a lazy DataFrame, so Catalyst pushes the
predicates into the Parquet reader.  Scans of a ``ResultTable`` resolve kinds and runs from its manifests
before any file is listed, so only the wanted folders are scanned.  Nothing is cached
here: the caller decides, and column pruning keeps working.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.time import since_literal
from flowlens.schemas import COUNT, KIND_CONN, RECORD_COLUMNS, TIPO, TS, TS_CODE, UID
from flowlens.sinks.tables import ResultTable


def scan_since(log: DataFrame, since) -> DataFrame:
    """All LOG rows ingested strictly after ``since`` (``TS_CODE > since``)."""
    if since is None:
        return log
    return log.where(F.col(TS_CODE) > since_literal(log, TS_CODE, since))


def scan_kind(log: DataFrame, kind: str, since=None) -> DataFrame:
    """S3: rows of one record kind (``TIPO = kind``) ingested after ``since``."""
    return scan_since(log.where(F.col(TIPO) == F.lit(kind)), since)


def scan_conn(log: DataFrame, since=None) -> DataFrame:
    return scan_kind(log, KIND_CONN, since)


def scan_results_uncounted(results: DataFrame | ResultTable, tipo: str, since=None) -> DataFrame:
    """Result rows of one kind that carry no ``COUNT``."""
    rows = results.read(tipo, since) if isinstance(results, ResultTable) else scan_kind(results, tipo, since)
    return rows.where(F.col(COUNT).isNull())


def _run_filter(df: DataFrame, run_id) -> DataFrame:
    if run_id is None:
        return df
    if run_id == "latest":
        # A frame has no manifests: a row per TIPO joined back.
        latest = df.groupBy(TIPO).agg(F.max("RUN_ID").alias("RUN_ID"))
        return df.join(latest, [TIPO, "RUN_ID"], "left_semi")
    return df.where(F.col("RUN_ID") == F.lit(run_id))


def scan_totals(totals: DataFrame | ResultTable, since=None, tipo: str | None = "RESP_H", run_id=None) -> DataFrame:
    """Stored totals newer than ``since``, one TIPO (``None`` = all), one run."""
    if isinstance(totals, ResultTable):
        return totals.read(tipo, since, run_id)
    df = totals if tipo is None else totals.where(F.col(TIPO) == F.lit(tipo))
    return _run_filter(scan_since(df, since), run_id)


def scan_kmeans_log(results: DataFrame | ResultTable, since=None, run_id=None) -> DataFrame:
    """Stored clustering results newer than ``since`` (optionally one run)."""
    if isinstance(results, ResultTable):
        return results.read(None, since, run_id)
    return _run_filter(scan_since(results, since), run_id)


def records(log: DataFrame, kind: str, since=None, limit: int | None = None) -> DataFrame:
    """The columns of one record kind.

    ``limit`` keeps the first rows by (TS, UID) so a sample is repeatable;
    by default every row is returned.
    """
    cols = RECORD_COLUMNS[kind]
    df = scan_kind(log, kind, since).select(*cols)
    if limit is not None:
        df = df.orderBy(F.col(TS), F.col(UID)).limit(limit)
    return df


def conn_records(log: DataFrame, since=None, limit=None) -> DataFrame:
    return records(log, "CONN", since, limit)


def dns_records(log: DataFrame, since=None, limit=None) -> DataFrame:
    return records(log, "DNS", since, limit)


def http_records(log: DataFrame, since=None, limit=None) -> DataFrame:
    return records(log, "HTTP", since, limit)
