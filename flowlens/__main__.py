"""Command line: run one of the jobs against Parquet tables.

    python -m flowlens totals  --log PATH --tables DIR [--since STAMP] [--run-ts STAMP]
    python -m flowlens ddos    --log PATH --tables DIR [--values http ssh]
    python -m flowlens scan    --log PATH --tables DIR [--values tcp udp]
    python -m flowlens records --log PATH --out DIR [--since STAMP]
    python -m flowlens export  --tables DIR --out DIR [--ip-info PATH] [--directory PATH] [--today DATE]
    python -m flowlens incremental --log PATH --tables DIR --checkpoint DIR

Under spark-submit the session comes from the cluster configuration; run
locally it is a local[*] session.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from flowlens.plans import jobs
from flowlens.schemas import DDOS_SERVICES, SCAN_PROTOS
from flowlens.session import configure, local_session


def _session(local: bool) -> SparkSession:
    if local:
        return local_session()
    return configure(SparkSession.builder.getOrCreate())


def _client(name: str | None):
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="flowlens")
    p.add_argument("job", choices=["records", "totals", "ddos", "scan", "export", "incremental"])
    p.add_argument("--log", help="LOG table (Parquet)")
    p.add_argument("--tables", help="folder of the result tables")
    p.add_argument("--out", help="folder of the CSV / JSON exports")
    p.add_argument("--since", default=None, help="ingest-time stamp; rows with TS_CODE > since")
    p.add_argument("--run-ts", default=None, help="run stamp (default: now)")
    p.add_argument("--run-id", default="latest", help="run to export (default: latest)")
    p.add_argument("--values", nargs="*", help="services (ddos) or protocols (scan)")
    p.add_argument("--most", type=int, default=100, help="columns of a source pivot beside OTHER (export job)")
    p.add_argument("--client", default=None, help="module:function that makes a lookup client (export job)")
    p.add_argument("--ip-info", default=None, help="IP_INFO cache table (export job)")
    p.add_argument("--directory", default=None, help="IP directory table for lookups (export job)")
    p.add_argument("--today", default=None, help="day of the lookup quota (export job)")
    p.add_argument("--checkpoint", default=None, help="streaming checkpoint folder (incremental job)")
    p.add_argument("--local", action="store_true", help="run on a local[*] session")
    a = p.parse_args(argv)

    spark = _session(a.local)
    metrics: dict = {}
    read = lambda path: spark.read.parquet(path) if path else None
    if a.job == "records":
        out = jobs.job_records(read(a.log), a.out, a.since)
    elif a.job == "totals":
        out = jobs.job_totals(read(a.log), a.tables, a.since, a.run_ts, metrics=metrics)
    elif a.job == "ddos":
        out = jobs.job_ddos(read(a.log), a.tables, tuple(a.values or DDOS_SERVICES), a.since, a.run_ts,
                            metrics=metrics)
    elif a.job == "scan":
        out = jobs.job_scan(read(a.log), a.tables, tuple(a.values or SCAN_PROTOS), a.since, a.run_ts,
                            metrics=metrics)
    elif a.job == "export":
        out = jobs.job_export(spark, a.tables, a.out, a.since, a.run_id, ip_info=a.ip_info,
                              directory=read(a.directory), make_client=_client(a.client), today=a.today,
                              most=a.most, run_ts=a.run_ts)
    else:
        from flowlens.streaming import run_incremental_totals

        run_incremental_totals(spark, a.log, a.tables, a.checkpoint)
        out = a.tables
    print(json.dumps({"job": a.job, "output": out, **metrics}))


if __name__ == "__main__":
    main()
