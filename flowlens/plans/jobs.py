"""The batch jobs, as functions with parameters instead of compile-time switches.

=========  ==========================================================
records    CONN/DNS/HTTP CSVs, web names joined to connections, totals
totals     the 21 hourly totals in one pass -> results table
ddos       per-minute counts per service, k-means -> results table
scan       per-minute counts per protocol, k-means -> results table
export     results tables -> JSON, pivots, totals CSVs, enrichment
=========  ==========================================================

Every job takes the caller's session and DataFrames or paths; ``since``
is the ingest-time high-water mark (strict ``TS_CODE > since``) and
``run_ts`` names the run (RUN_ID) so reruns replace their own output.
"""

from __future__ import annotations

import datetime as dt
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import totals as TOT
from flowlens.plans import exports as X
from flowlens.schemas import DDOS_SERVICES, SCAN_PROTOS
from flowlens.session import discard, path_exists, reliable_checkpoint
from flowlens.sinks.cache import LookupCache
from flowlens.sinks.files import write_csv
from flowlens.sinks.models import ModelStore
from flowlens.sinks.quota import QuotaBook
from flowlens.sinks.state import TotalsState
from flowlens.sinks.tables import ResultTable, append_run, run_id_of, stamp_run, write_results
from flowlens.sources import scans

LOG_TOTAIS = "LOG_TOTAIS"
LOG_TOTAIS_ALL = "LOG_TOTAIS_ALL"
LOG_KMEANS_DDOS = "LOG_KMEANS_DDOS"
LOG_KMEANS_SCAN_PORT = "LOG_KMEANS_SCAN_PORT"
IP_INFO = "IP_INFO"
_log = logging.getLogger(__name__)


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def job_records(log: DataFrame, out_dir: str, since=None) -> list[str]:
    """Job 1: record exports and the web-name report, over all rows."""
    return X.export_records(log, out_dir, since) + X.export_www(log, out_dir, since)


def job_totals(log: DataFrame, tables_dir: str, since=None, run_ts=None, strategy="families",
               row_id: bool = False, metrics: dict | None = None, merge: bool = False) -> str:
    """Job 5: the 21 hourly totals -> LOG_TOTAIS partitioned by TIPO and RUN_ID.

    By families (or ``union``) a task of the last aggregate holds few kinds, so it writes them itself: its rows are shuffled once.

    ``merge``: the run's totals are also added to the all-time totals LOG_TOTAIS_ALL, once: a rerun adds nothing to them.
    """
    run_ts = run_ts or _now()
    conn = scans.scan_conn(log, since)
    res = stamp_run(TOT.totals_all(conn, strategy=strategy), run_ts, since, row_id)
    path = write_results(res, os.path.join(tables_dir, LOG_TOTAIS), metrics=metrics, replaces={"RUN_ID": run_id_of(run_ts)},
                         deal=strategy not in ("families", "union"))
    if merge:
        run = run_id_of(run_ts)
        TotalsState(log.sparkSession, os.path.join(tables_dir, LOG_TOTAIS_ALL)).merge(ResultTable(log.sparkSession, path).read(run_id=run), f"RUN_ID={run}")
    return path


def _kmeans_job(conn: DataFrame, kind: str, values, tables_dir: str, table: str, since, run_ts,
                k: int, seed: int, row_id: bool, metrics: dict | None = None) -> str:
    """One per-minute aggregate for all values, stored once; one model per value, its cost in ``metrics``."""
    path, models = os.path.join(tables_dir, table), _models(conn.sparkSession, tables_dir, table)
    column = "SERVICE" if kind == "ddos" else "PROTO"
    minutes = reliable_checkpoint(MIN.minutes_for(conn, kind, values))
    for v in values:
        rows = minutes.where(F.col(column) == v)
        model = CL.fit(rows, k=k, seed=seed)
        models.save(model, v, run_id_of(run_ts))
        labelled = CL.assign(rows, model, k)
        res = stamp_run(labelled.withColumn("TIPO", F.lit(v)), run_ts, since, row_id)
        write_results(res, path, metrics=metrics, replaces={"TIPO": v, "RUN_ID": run_id_of(run_ts)})
        if metrics is not None:
            metrics.setdefault("wssse", {})[v] = CL.kmeans_cost(labelled).first()["WSSSE"]
    discard(minutes)
    return path


def job_ddos(log: DataFrame, tables_dir: str, services=DDOS_SERVICES, since=None, run_ts=None,
             k: int = 2, seed: int = CL.DEFAULT_SEED, row_id: bool = False, metrics: dict | None = None) -> str:
    """Job 6: DDoS candidates per service."""
    conn = scans.scan_conn(log, since)
    return _kmeans_job(conn, "ddos", services, tables_dir, LOG_KMEANS_DDOS, since, run_ts or _now(), k, seed, row_id,
                       metrics)


def job_scan(log: DataFrame, tables_dir: str, protos=SCAN_PROTOS, since=None, run_ts=None,
             k: int = 2, seed: int = CL.DEFAULT_SEED, row_id: bool = False, metrics: dict | None = None) -> str:
    """Job 7: port-scan candidates per protocol."""
    conn = scans.scan_conn(log, since)
    return _kmeans_job(conn, "scan", protos, tables_dir, LOG_KMEANS_SCAN_PORT, since, run_ts or _now(), k, seed,
                       row_id, metrics)


def _models(spark: SparkSession, tables_dir: str, table: str) -> ModelStore:
    return ModelStore(spark, os.path.join(tables_dir, table + "_MODELS"))


def job_label(log: DataFrame, tables_dir: str, kind: str, values, since=None, run_ts=None, model_run: int | str = "latest",
              metrics: dict | None = None) -> str:
    """Label the minutes after ``since`` with the models of an earlier run of job 6 (``ddos``) or 7 (``scan``).

    The rows become a run of the same results table; nothing is fitted, and nothing is read but the new rows.
    """
    table = {"ddos": LOG_KMEANS_DDOS, "scan": LOG_KMEANS_SCAN_PORT}[kind]
    run_ts = run_ts or _now()
    models, path = _models(log.sparkSession, tables_dir, table), os.path.join(tables_dir, table)
    column = "SERVICE" if kind == "ddos" else "PROTO"
    minutes = MIN.minutes_for(scans.scan_conn(log, since), kind, values)
    labelled = [CL.assign(minutes.where(F.col(column) == v), models.load(v, model_run)).withColumn("TIPO", F.lit(v)) for v in values]
    for v, rows in zip(values, labelled):
        write_results(stamp_run(rows, run_ts, since), path, metrics=metrics, replaces={"TIPO": v, "RUN_ID": run_id_of(run_ts)})
    return path


def _stored(spark: SparkSession, path: str) -> ResultTable | None:
    if path_exists(spark, path):
        return ResultTable(spark, path)
    _log.warning("no table at %s: its exports are skipped", path)
    return None


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The IP_INFO cache at ``path``, compacted or not; it must be partitioned by RUN_ID, as runs are added to it."""
    cache = LookupCache(spark, path)
    if cache.is_empty():
        raise ValueError(f"the IP_INFO table at {path} has no RUN_ID partitions; write it once with sinks.append_run(rows, path, 0)")
    return cache.read()


def job_export(spark: SparkSession, tables_dir: str, out_dir: str, since=None, run_id="latest",
               ip_info: DataFrame | str | None = None, directory: DataFrame | None = None, make_client=None, today=None,
               lookup_limit: int = EN.DAILY_QUOTA, most: int = 100, run_ts=None) -> list[str]:
    """Job 8: exports from the result tables, and the enriched responder report.

    ``ip_info`` is the cache: a path (new lookups become a run partition
    there), or a frame (they go to IP_INFO under ``tables_dir``).  Hosts it lacks come from
    ``directory``, or from the service that ``make_client`` connects to
    (at most ``lookup_limit`` a run, within the day's quota).
    """
    out = []
    run_ts = run_ts or _now()
    cache_path = ip_info if isinstance(ip_info, str) else os.path.join(tables_dir, IP_INFO)
    if isinstance(ip_info, str):
        ip_info = read_cache(spark, ip_info)
    ddos = _stored(spark, os.path.join(tables_dir, LOG_KMEANS_DDOS))
    if ddos is not None:
        out += X.export_kmeans(scans.scan_kmeans_log(ddos, since, run_id), out_dir, "DDoS_", "SERVICE", most=most, timeline="GRF_DDOS_IP")
    scan = _stored(spark, os.path.join(tables_dir, LOG_KMEANS_SCAN_PORT))
    if scan is not None:
        out += X.export_kmeans(scans.scan_kmeans_log(scan, since, run_id), out_dir, "Scan_", "PROTO", most=most)
    stored = _stored(spark, os.path.join(tables_dir, LOG_TOTAIS))
    if stored is not None:
        totals = scans.scan_totals(stored, since, tipo=None, run_id=run_id)
        out += X.export_totals(totals, out_dir)
        out += X.export_totals_pivots(totals, out_dir, most)
        if ip_info is not None:
            resp_h = totals.where(F.col("TIPO") == "RESP_H")
            enriched, new_rows = EN.enrich(resp_h, ip_info, directory=directory, make_client=make_client,
                                           today=today or _now().date(), limit=lookup_limit, run_ts=run_ts,
                                           book=QuotaBook(spark, os.path.join(tables_dir, "IP_QUOTA"), EN.DAILY_QUOTA))
            out.append(X.export_resp_h_info(enriched, out_dir))
            if new_rows is not None:
                new_rows = reliable_checkpoint(new_rows)  # the cache it came from is written to
                out.append(append_run(new_rows, cache_path, run_id_of(run_ts)))
    return out


__all__ = ["job_records", "job_totals", "job_ddos", "job_scan", "job_label", "job_export", "read_cache", "run_id_of", "write_csv"]
