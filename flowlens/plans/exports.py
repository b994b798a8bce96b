"""The CSV / JSON exports of the jobs.

Sorts happen here and only here.  Time buckets stay timestamps for the
sort (so 30.11 comes before 01.12) and become text labels at the end.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.time import label
from flowlens.operators import pivot as PV
from flowlens.operators import totals as TOT
from flowlens.operators import web as WEB
from flowlens.schemas import COUNT, RESP_H, TIPO, TOTALS, TOTALS_BY_TIPO, TS
from flowlens.session import discard, reliable_checkpoint
from flowlens.sinks.files import write_csv, write_parts
from flowlens.sources import scans


def _p(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, name)


def export_records(log: DataFrame, out_dir: str, since=None, limit=None, single_file=False) -> list[str]:
    """CONN-ALL, DNS-ALL, HTTP-ALL."""
    out = []
    for kind in ("CONN", "DNS", "HTTP"):
        df = scans.records(log, kind, since, limit)
        out.append(write_csv(df, _p(out_dir, f"{kind}-ALL"), single_file=single_file))
    return out


def export_www(log: DataFrame, out_dir: str, since=None, single_file=False) -> list[str]:
    """CONN-WWW (connections with their web name) and CONN-WWW-SUM."""
    dns = WEB.dns_www(scans.dns_records(log, since))
    joined = WEB.conn_by_dns_query(scans.conn_records(log, since), dns)
    return [
        write_csv(joined, _p(out_dir, "CONN-WWW"), WEB.conn_by_query_order(), single_file),
        write_csv(WEB.www_totals(joined), _p(out_dir, "CONN-WWW-SUM"), WEB.www_totals_order(), single_file),
    ]


def export_totals(totals: DataFrame, out_dir: str, tipos=None, single_file=False) -> list[str]:
    """X3 with T1: a CSV folder per TIPO, each in that total's sort order, from one sort and one write of all of them."""
    specs = TOTALS if tipos is None else [TOTALS_BY_TIPO[t] for t in tipos]
    names = [s.tipo for s in specs]
    keys = TOT.export_keys(specs)
    rows = totals.where(F.col(TIPO).isin(names)).withColumns(keys)
    return write_parts(rows, out_dir, TIPO, str, [F.col(k).asc_nulls_first() for k in keys], single_file=single_file, drop=tuple(keys), expected=names)


def _labelled(pivoted: DataFrame, unit: str) -> DataFrame:
    """Text label in TS; the real bucket kept in ``_bucket`` for the sort."""
    return pivoted.withColumn("_bucket", F.col(TS)).withColumn(TS, label(TS, unit))


def export_pivot(df: DataFrame, out_dir: str, name: str, dim: str, units=("hour", "day"),
                 most: int = 100, values=None, where=None, single_file=False) -> list[str]:
    """Per unit, ``<name>_LONG_<H|D|M>`` (every value) and ``<name>_PIVOT_<H|D|M>``.

    The long form is the complete result.  The pivot has a column for each of
    ``values`` (default: the ``most`` busiest) and OTHER for the rest.
    """
    out = []
    for unit in units:
        long = reliable_checkpoint(PV.long_counts(df, dim, unit, where=where))
        suffix = {"minute": "M", "hour": "H", "day": "D"}[unit]
        out.append(write_csv(_labelled(long, unit), _p(out_dir, f"{name}_LONG_{suffix}"), [F.col("_bucket"), F.col(dim)],
                             single_file, drop=("_bucket",)))
        wide = PV.wide(long, dim, PV.top_values(long, dim, most) if values is None else values)
        out.append(write_csv(_labelled(wide, unit), _p(out_dir, f"{name}_PIVOT_{suffix}"), [F.col("_bucket")],
                             single_file, drop=("_bucket",)))
        discard(long)
    return out


def export_totals_pivots(totals: DataFrame, out_dir: str, most: int = 100) -> list[str]:
    """V1 exports: protocol and service history, and per-source HTTP history.

    Each pivot reads one TIPO only, so no count is added up twice.
    """
    out = []
    out += export_pivot(totals.where(F.col(TIPO) == "PROTO"), out_dir, "PROTO_", "PROTO", most=most)
    out += export_pivot(totals.where(F.col(TIPO) == "SERVICE"), out_dir, "SERVICE_", "SERVICE", most=most)
    out += export_pivot(totals.where(F.col(TIPO) == "PROTO_SERVICE_ORIG_H"), out_dir,
                        "PROTO_SERVICE_ORIG_H_http", "ID_ORIG_H", most=most, where=F.col("SERVICE") == "http")
    return out


def export_pivots_by(df: DataFrame, out_dir: str, name, by: str, dim: str, units=("minute", "hour"), most: int = 100,
                     single_file=False) -> list[str]:
    """X5 for every value of ``by`` at once: per unit one aggregate, one write of all long forms and one of all pivots.

    The pivots share their columns: the ``most`` busiest of all values together, and OTHER.
    """
    out = []
    for unit in units:
        long = reliable_checkpoint(PV.long_counts(df, dim, unit, keys=(by,)))
        suffix = {"minute": "M", "hour": "H", "day": "D"}[unit]
        for rows, kind, order in ((long, "LONG", ["_bucket", dim]), (PV.wide(long, dim, PV.top_values(long, dim, most), keys=(by,)), "PIVOT", ["_bucket"])):
            out += write_parts(_labelled(rows, unit), out_dir, by, lambda v, k=kind: f"{name(v)}_{k}_{suffix}",
                               [F.col(c) for c in order], single_file=single_file, drop=("_bucket", by))
        discard(long)
    return out


def export_kmeans(results: DataFrame, out_dir: str, prefix: str, column: str,
                  most: int = 100, single_file: bool = False, timeline: str | None = None) -> list[str]:
    """X4 + V2 + V3: rows of each value of ``column`` as JSON, per-minute and per-hour source pivots, and all sources' timeline.

    The number of jobs does not grow with the number of values.
    """
    def name(value: str) -> str:
        return f"{prefix}{value}"

    out = write_parts(results, out_dir, column, name, [F.col(TS)], fmt="json", single_file=single_file)
    out += export_pivots_by(results, out_dir, name, column, "ID_ORIG_H", most=most, single_file=single_file)
    if timeline:
        out += export_pivot(results, out_dir, timeline, "ID_ORIG_H", units=("minute",), most=most)
    return out


def export_resp_h_info(enriched: DataFrame, out_dir: str, single_file=False) -> str:
    """E11 output: RESP_H totals with host attributes, busiest first."""
    return write_csv(enriched, _p(out_dir, "RESP_H_INFO_WEB"),
                     [F.col(COUNT).desc(), F.col(TS), F.col(RESP_H)], single_file)
