"""The registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)``, builds the fixture tables from the
driver's parquet files and returns a lazy DataFrame over all of them.
Double columns are rounded to 4 places on both sides (summation order
differs between engines); ids that depend on partitioning (ROW_ID) and run
stamps are not part of any registered result.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import pivot as PV
from flowlens.operators import totals as TOT
from flowlens.operators import web as WEB
from flowlens.plans import oracle_sql as O
from flowlens.functions.time import label
from flowlens.plans import jobs
from flowlens.schemas import DDOS_KEYS, DDOS_SERVICES, RECORD_COLUMNS, SCAN_KEYS, SCAN_PROTOS, TOTALS, TOTALS_COLUMNS
from flowlens.session import configure, ensure_checkpoint_dir, reliable_checkpoint
from flowlens.sinks.cache import LookupCache
from flowlens.sinks.state import TotalsState
from flowlens.sinks.tables import RUN_COLUMNS, ResultTable, append_run, run_id_of, stamp_run, write_results
from flowlens.sources import fixtures, scans

SINCE = fixtures.DEFAULT_SINCE


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every double column (including inside arrays) to ``places``."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(c, places).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            cols.append(F.transform(c, lambda x: F.round(x, places)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


_SESSIONS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _once(spark: SparkSession, key, build):
    """``build()``, kept as long as its session object lives."""
    kept = _SESSIONS.setdefault(spark, {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def tables(spark: SparkSession, sf_dir: str) -> fixtures.Tables:
    """Fixture tables of ``sf_dir``, built once per session (lazy DataFrames); the session gets the library's settings."""
    return _once(spark, ("tables", sf_dir), lambda: fixtures.load(configure(spark), sf_dir))


LOG_UNCOUNTED = "LOG_UNCOUNTED"


def _uncounted(log: DataFrame, folder: str, since, run_ts) -> None:
    """A run whose even counts are blank, of two kinds."""
    c = scans.scan_conn(log, since)
    both = TOT.totals(c, "RESP_H").unionByName(TOT.totals(c, "PROTO"))
    blank = F.when(F.col("COUNT") % 2 != 0, F.col("COUNT")).alias("COUNT")
    rows = stamp_run(both.select(*(blank if name == "COUNT" else name for name in TOTALS_COLUMNS)), run_ts)
    write_results(rows, f"{folder}/{LOG_UNCOUNTED}", replaces={"RUN_ID": run_id_of(run_ts)})


def stored(spark: SparkSession, sf_dir: str, table: str) -> ResultTable:
    """A result table in the shared folder, written by its job for two runs: all rows, then those after SINCE."""
    job = {jobs.LOG_TOTAIS: jobs.job_totals, jobs.LOG_KMEANS_DDOS: jobs.job_ddos, LOG_UNCOUNTED: _uncounted}[table]

    def build():
        folder = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
        for run_ts, since in ((O.EARLIER_RUN, None), (O.RUN_TS, SINCE)):
            job(tables(spark, sf_dir).log, folder, since=since, run_ts=run_ts)
        return f"{folder}/{table}"

    return ResultTable(spark, _once(spark, (table, sf_dir), build))


def conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_conn(tables(spark, sf_dir).log, SINCE)


_REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        _REGISTRY[name] = Query(name, lambda spark, sf_dir: rounded(fn(spark, sf_dir)), sql)
        return fn

    return deco


# ------------------------------------------------------------------ totals
def _total_query(spec):
    def run(spark, sf_dir):
        return TOT.totals(conn(spark, sf_dir), spec)

    return run


for _spec in TOTALS:
    register(_spec.query_name, O.totals_sql(_spec))(_total_query(_spec))


@register("totals_all", O.totals_all_sql())
def _totals_all(spark, sf_dir):
    return TOT.totals_all(conn(spark, sf_dir))


# ------------------------------------------------------------------- scans
@register("scan_log_since", O.with_ctes(f"SELECT * FROM LOG WHERE TS_CODE > {O.SINCE_SQL}"))
def _scan_log_since(spark, sf_dir):
    return scans.scan_since(tables(spark, sf_dir).log, SINCE)


@register("scan_conn_since", O.with_ctes("SELECT * FROM conn"))
def _scan_conn_since(spark, sf_dir):
    return conn(spark, sf_dir)


def _records_sql(kind: str) -> str:
    cols = ", ".join(RECORD_COLUMNS[kind])
    return O.with_ctes(f"SELECT {cols} FROM LOG WHERE TIPO = '{kind}' AND TS_CODE > {O.SINCE_SQL}")


@register("conn_records", _records_sql("CONN"))
def _conn_records(spark, sf_dir):
    return scans.conn_records(tables(spark, sf_dir).log, SINCE)


@register("dns_records", _records_sql("DNS"))
def _dns_records(spark, sf_dir):
    return scans.dns_records(tables(spark, sf_dir).log, SINCE)


@register("http_records", _records_sql("HTTP"))
def _http_records(spark, sf_dir):
    return scans.http_records(tables(spark, sf_dir).log, SINCE)


# --------------------------------------------------------------- web names


def _dns_www(spark, sf_dir):
    return WEB.dns_www(scans.dns_records(tables(spark, sf_dir).log, SINCE))


def _conn_by_query(spark, sf_dir):
    t = tables(spark, sf_dir)
    return WEB.conn_by_dns_query(scans.conn_records(t.log, SINCE), WEB.dns_www(scans.dns_records(t.log, SINCE)))


register("dns_www", O.dns_www_sql())(_dns_www)
register("conn_by_dns_query", O.conn_by_query_sql())(_conn_by_query)


@register("www_totals", O.www_totals_sql())
def _www_totals(spark, sf_dir):
    return WEB.www_totals(_conn_by_query(spark, sf_dir))


@register("top_consumers", O.top_consumers_sql(100))
def _top_consumers(spark, sf_dir):
    return WEB.top_consumers(scans.conn_records(tables(spark, sf_dir).log, SINCE), 100)


# ------------------------------------------------------- per-minute tables


def _minutes(kind, value):
    def run(spark, sf_dir):
        c = conn(spark, sf_dir)
        return MIN.ddos_minutes(c, value) if kind == "ddos" else MIN.scan_minutes(c, value)

    return run


for _v in DDOS_SERVICES:
    register(f"ddos_minutes_{_v}", O.minutes_sql("ddos", _v))(_minutes("ddos", _v))
for _v in SCAN_PROTOS:
    register(f"scan_minutes_{_v}", O.minutes_sql("scan", _v))(_minutes("scan", _v))


@register("scan_minutes_tcp_ports", O.scan_ports_sql("tcp"))
def _scan_ports(spark, sf_dir):
    return MIN.scan_minutes(conn(spark, sf_dir), "tcp", distinct_resp_ports=True)


@register("scan_hours_tcp_ports", O.scan_hours_ports_sql("tcp"))
def _scan_hours_ports(spark, sf_dir):
    """Distinct target ports an hour, from the union of the minutes' sketches."""
    return MIN.distinct_ports(MIN.union_sketches(MIN.port_sketches(conn(spark, sf_dir), "tcp")))


def _two_means(kind, value):
    def run(spark, sf_dir):
        return CL.two_means_exact(_minutes(kind, value)(spark, sf_dir), "COUNT")

    return run


for _kind, _values in (("ddos", DDOS_SERVICES), ("scan", SCAN_PROTOS)):
    for _v in _values:
        register(f"two_means_exact_{_v}", O.two_means_sql(_kind, _v))(_two_means(_kind, _v))


# ------------------------------------------------------------- clustering
# Checked by SQL through the exact split, the optimum in one dimension; the
# cluster index depends on the start and is left out, centres are sorted.
MINUTE_MEASURES = ("DURATION", "ORIG_PKTS", "ORIG_IP_BYTES", "ORIG_BYTES", "RESP_PKTS", "RESP_IP_BYTES", "RESP_BYTES", "COUNT")


def _kmeans(kind, value):
    def run(spark, sf_dir):
        return CL.kmeans(_minutes(kind, value)(spark, sf_dir), features=("COUNT",), k=2)

    return run


def _without_index(df, kind):
    keys = DDOS_KEYS if kind == "ddos" else SCAN_KEYS
    return df.select(*keys, "TS", *MINUTE_MEASURES, F.sort_array(F.flatten("CENTROIDS")).alias("CENTRES"), "IS_HIGH")


def _kmeans_rows(kind, value):
    return lambda spark, sf_dir: _without_index(_kmeans(kind, value)(spark, sf_dir), kind)


def _kmeans_labels(kind, value):
    keys = list(DDOS_KEYS if kind == "ddos" else SCAN_KEYS)

    def run(spark, sf_dir):
        return _kmeans(kind, value)(spark, sf_dir).select(*keys, "TS", "COUNT", "IS_HIGH")

    return run


for _kind, _values in (("ddos", DDOS_SERVICES), ("scan", SCAN_PROTOS)):
    for _v in _values:
        register(f"kmeans_{_kind}_{_v}", O.kmeans_sql(_kind, _v))(_kmeans_rows(_kind, _v))
        register(f"kmeans_labels_{_v}", O.kmeans_labels_sql(_kind, _v))(_kmeans_labels(_kind, _v))


@register("kmeans_multi", O.kmeans_multi_sql("http"))
def _kmeans_multi(spark, sf_dir):
    """The rows clustered, and whether each is at its nearest centre (labels depend on the start)."""
    features = ("DURATION", "ORIG_PKTS", "ORIG_BYTES")
    point = F.array(*(F.col(c).cast("double") for c in features))
    away = F.transform("CENTROIDS", lambda c: F.aggregate(
        F.zip_with(c, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    nearest = F.element_at(away, F.col("prediction") + 1) <= F.array_min(away) * (1 + 1e-9)
    return CL.kmeans_multi(_minutes("ddos", "http")(spark, sf_dir), features).select(
        *DDOS_KEYS, "TS", *features, nearest.alias("NEAREST"))


@register("kmeans_multi_fixed", O.kmeans_multi_fixed_sql("http"))
def _kmeans_multi_fixed(spark, sf_dir):
    """A proof for any start: Lloyd's method run to its end, each row of which is at a centre that is the mean of its rows."""
    features = ("DURATION", "ORIG_PKTS", "ORIG_BYTES")
    rows = CL.kmeans_multi(_minutes("ddos", "http")(spark, sf_dir), features, tol=0.0, max_iter=200)
    rows = reliable_checkpoint(rows)
    apart = F.array_max(F.zip_with("CENTRE", "MEAN", lambda a, b: F.abs(a - b) / (1 + F.abs(b))))
    means = CL.centre_means(rows, features).select("prediction", (apart < 1e-9).alias("FIXED"))
    return rows.join(means, "prediction").select(*DDOS_KEYS, "TS", *features, "FIXED")


@register("kmeans_wssse", O.kmeans_cost_sql("ddos", "http"))
def _kmeans_wssse(spark, sf_dir):
    return CL.kmeans_cost(_kmeans("ddos", "http")(spark, sf_dir), ("COUNT",))


@register("kmeans_silhouette", O.silhouette_sql("ddos", "http"))
def _kmeans_silhouette(spark, sf_dir):
    return CL.silhouette(_kmeans("ddos", "http")(spark, sf_dir), ("COUNT",))


# ------------------------------------------------------------ enrichment


def _resp_h_totals(spark, sf_dir):
    return TOT.totals(conn(spark, sf_dir), "RESP_H")


def _batch(spark, sf_dir):
    """E5, of the function form: quota and a limit below the misses there are."""
    t = tables(spark, sf_dir)
    free = EN.lookup_quota(t.ip_info, O.TODAY).first()["FREE"]
    return EN.lookup_batch(_resp_h_totals(spark, sf_dir), t.ip_info, free, limit=O.BATCH_LIMIT)


def _looked(spark, sf_dir):
    """E6, table form: every host the cache lacks, joined with the directory."""
    t = tables(spark, sf_dir)
    return EN.lookup(EN.cache_misses(conn(spark, sf_dir), t.ip_info), t.ip_directory, run_ts=O.RUN_TS)


def _enrich_query(name, fn):
    register(name, O.enrich_sql(O.ENRICH_QUERIES[name.removesuffix("_compacted").removesuffix("_bloom")]))(fn)


_enrich_query("lookups_today", lambda spark, d: EN.lookup_quota(tables(spark, d).ip_info, O.TODAY))
_enrich_query("distinct_resp_hosts", lambda spark, d: EN.distinct_hosts(conn(spark, d)))
_enrich_query("ip_cache_hits", lambda spark, d: EN.cache_hits(tables(spark, d).ip_info, conn(spark, d)))
_enrich_query("ip_cache_misses", lambda spark, d: EN.cache_misses(conn(spark, d), tables(spark, d).ip_info))
_enrich_query("ip_cache_hits_bloom", lambda spark, d: EN.cache_hits(
    EN.possible_hits(tables(spark, d).ip_info, conn(spark, d)), conn(spark, d)))
_enrich_query("ip_cache_misses_bloom", lambda spark, d: EN.cache_misses(
    conn(spark, d), EN.possible_hits(tables(spark, d).ip_info, conn(spark, d))))
_enrich_query("resp_host_counts", lambda spark, d: TOT.resp_host_counts(_resp_h_totals(spark, d)))
_enrich_query("top_resp_hosts", lambda spark, d: TOT.top_resp_hosts(_resp_h_totals(spark, d), O.TOP_HOSTS))
_enrich_query("lookup_batch", lambda spark, d: _batch(spark, d))
_enrich_query("enrich_lookup", _looked)


@register("ip_info_union", O.enrich_sql(O.ENRICH_QUERIES["ip_info_union"]))
def _ip_info_union(spark, sf_dir):
    t = tables(spark, sf_dir)
    return EN.ip_info_union(EN.latest_ip_info(t.ip_info), _looked(spark, sf_dir))


@register("enrich_resp_hosts", O.enrich_sql(O.ENRICH_QUERIES["enrich_resp_hosts"]))
def _enrich_resp_hosts(spark, sf_dir):
    t = tables(spark, sf_dir)
    return EN.attach_ip_info(TOT.totals(scans.scan_conn(t.log, SINCE), "RESP_H"), EN.latest_ip_info(t.ip_info),
                             unique=True)


@register("export_resp_h_info", O.enrich_sql(O.ENRICH_QUERIES["export_resp_h_info"]))
def _export_resp_h_info(spark, sf_dir):
    t = tables(spark, sf_dir)
    enriched, _new = EN.enrich(_resp_h_totals(spark, sf_dir), t.ip_info, directory=t.ip_directory, run_ts=O.RUN_TS)
    return enriched


# ----------------------------------------------------------------- pivots

# Fixture values of the small dimensions, for the oracle's fixed columns.
PROTO_VALUES = ["tcp", "udp"]
SERVICE_VALUES = [None, "dns", "http", "ssh", "ssl"]


def _pivot_totals(tipo, dim, unit, values):
    return lambda spark, sf_dir: PV.pivot_counts(TOT.totals(conn(spark, sf_dir), tipo), dim, unit, values=values)


def _long_totals(tipo, dim, unit, service=None):
    def run(spark, sf_dir):
        where = F.col("SERVICE") == service if service else None
        return PV.long_counts(TOT.totals(conn(spark, sf_dir), tipo), dim, unit, where=where)

    return run


def _long_minutes(kind, values, unit):
    return lambda spark, sf_dir: PV.long_counts(MIN.minutes_for(conn(spark, sf_dir), kind, values), "ID_ORIG_H", unit)


for _unit in ("hour", "day"):
    register(f"pivot_proto_{_unit}", O.pivot_totals_sql("PROTO", "PROTO", _unit, PROTO_VALUES))(
        _pivot_totals("PROTO", "PROTO", _unit, PROTO_VALUES))
    register(f"pivot_service_{_unit}", O.pivot_totals_sql("SERVICE", "SERVICE", _unit, SERVICE_VALUES))(
        _pivot_totals("SERVICE", "SERVICE", _unit, SERVICE_VALUES))
    # Some values only: the rest goes to OTHER.
    register(f"pivot_service_other_{_unit}", O.pivot_totals_sql("SERVICE", "SERVICE", _unit, SERVICE_VALUES[:3]))(
        _pivot_totals("SERVICE", "SERVICE", _unit, SERVICE_VALUES[:3]))
    # Per source the complete result is the long form.
    register(f"pivot_http_orig_{_unit}", O.long_totals_sql("PROTO_SERVICE_ORIG_H", "ID_ORIG_H", _unit, where="SERVICE = 'http'"))(
        _long_totals("PROTO_SERVICE_ORIG_H", "ID_ORIG_H", _unit, service="http"))
    register(f"long_proto_service_{_unit}", O.long_totals_sql("PROTO_SERVICE", "SERVICE", _unit))(
        _long_totals("PROTO_SERVICE", "SERVICE", _unit))


@register("pivot_proto_day_label", O.pivot_totals_sql("PROTO", "PROTO", "day", PROTO_VALUES, label="%d.%m.%Y"))
def _pivot_label(spark, sf_dir):
    return _pivot_totals("PROTO", "PROTO", "day", PROTO_VALUES)(spark, sf_dir).withColumn("TS", label("TS", "day"))


for _kind, _values in (("ddos", DDOS_SERVICES), ("scan", SCAN_PROTOS)):
    for _v in _values:
        for _unit in ("minute", "hour"):
            register(f"pivot_{_kind}_{_v}_{_unit}", O.long_minutes_sql(_kind, [_v], "ID_ORIG_H", _unit))(
                _long_minutes(_kind, [_v], _unit))

# V3: the timeline of all sources, over every clustered service.
register("pivot_orig_minute", O.long_minutes_sql("ddos", DDOS_SERVICES, "ID_ORIG_H", "minute"))(
    _long_minutes("ddos", DDOS_SERVICES, "minute"))


# ------------------------------------------------- scans of stored results
# Tables that the jobs wrote for two runs, read back with their partitions pruned.
@register("scan_totals", O.with_ctes("SELECT * FROM resp_h_totals", O.resp_h_totals_cte()))
def _scan_totals(spark, sf_dir):
    """The newest run."""
    table = stored(spark, sf_dir, jobs.LOG_TOTAIS)
    return scans.scan_totals(table, since=O.TODAY, tipo="RESP_H", run_id="latest").select(*TOTALS_COLUMNS)


@register("scan_totals_since", O.with_ctes("SELECT * FROM resp_h_totals", O.resp_h_totals_cte()))
def _scan_totals_since(spark, sf_dir):
    """The runs strictly after the stamp of the earlier one."""
    return scans.scan_totals(stored(spark, sf_dir, jobs.LOG_TOTAIS), since=O.EARLIER_RUN, tipo="RESP_H").select(*TOTALS_COLUMNS)


@register("scan_kmeans_log", "\nUNION ALL\n".join(f"SELECT * FROM ({O.kmeans_sql('ddos', v)}) {v}_rows" for v in DDOS_SERVICES))
def _scan_kmeans_log(spark, sf_dir):
    return _without_index(scans.scan_kmeans_log(stored(spark, sf_dir, jobs.LOG_KMEANS_DDOS), since=O.TODAY, run_id="latest"), "ddos")


@register("scan_results_uncounted", O.uncounted_sql())
def _scan_results_uncounted(spark, sf_dir):
    """Result rows without a count: here the even counts are blank, of one kind of two and one run of two."""
    table = stored(spark, sf_dir, LOG_UNCOUNTED)
    return scans.scan_results_uncounted(table, "RESP_H", since=O.EARLIER_RUN).drop(*RUN_COLUMNS)


@register("stored_runs", O.stored_runs_sql())
def _stored_runs(spark, sf_dir):
    """The runs and kinds of a table by its manifests, and the rows that reading each kind of the newest run gives."""
    table = stored(spark, sf_dir, jobs.LOG_TOTAIS)
    counted = table.read(run_id="latest").groupBy("TIPO", "RUN_ID").agg(F.count("*").alias("N"))
    return table.runs(since=O.TODAY).join(counted, ["TIPO", "RUN_ID"], "left")


def _export_totals(spec):
    def run(spark, sf_dir):
        table = stored(spark, sf_dir, jobs.LOG_TOTAIS)
        rows = scans.scan_totals(table, since=O.TODAY, tipo=spec.tipo, run_id="latest")
        return rows.select(*TOTALS_COLUMNS).orderBy(*TOT.export_order(spec))

    return run


for _spec in TOTALS:
    register("export_" + _spec.query_name, O.totals_sql(_spec))(_export_totals(_spec))


# ------------------------------------- state, models and cache that outlive a run
@register("totals_merged", O.totals_all_sql())
def _totals_merged(spark, sf_dir):
    """All-time totals from three runs by ingest time, the second of them replayed.

    A run's totals are stored before they are merged, so each set has its own aggregate: a task holds the groups of one.
    """
    rows = conn(spark, sf_dir)
    low, high = rows.agg(F.min("TS_CODE"), F.max("TS_CODE")).first()
    cuts = [low + (high - low) / 3, low + 2 * (high - low) / 3]
    runs = [rows.where(F.col("TS_CODE") <= cuts[0]), rows.where((F.col("TS_CODE") > cuts[0]) & (F.col("TS_CODE") <= cuts[1])),
            rows.where(F.col("TS_CODE") > cuts[1])]
    state = TotalsState(spark, f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}")
    for n in (0, 1, 1, 2):
        state.merge(TOT.totals_all(runs[n], strategy="union"), f"RUN_ID={n}")
    return state.read()


def _labelled_later(kind, value):
    keys = list(DDOS_KEYS if kind == "ddos" else SCAN_KEYS)

    def run(spark, sf_dir):
        log = tables(spark, sf_dir).log
        folder = f"{ensure_checkpoint_dir(spark)}/later-{uuid.uuid4().hex}"
        earlier = log.where(F.col("TS_CODE") <= F.lit(SINCE).cast(log.schema["TS_CODE"].dataType))
        job = jobs.job_ddos if kind == "ddos" else jobs.job_scan
        job(earlier, folder, (value,), run_ts=O.EARLIER_RUN)
        path = jobs.job_label(log, folder, kind, (value,), since=SINCE, run_ts=O.RUN_TS)
        rows = ResultTable(spark, path).read(value, run_id=run_id_of(O.RUN_TS))
        return rows.select(*keys, "TS", "COUNT", F.sort_array(F.flatten("CENTROIDS")).alias("CENTRES"), "IS_HIGH")

    return run


for _kind, _value in (("ddos", "http"), ("scan", "tcp")):
    register(f"kmeans_later_{_value}", O.kmeans_later_sql(_kind, _value))(_labelled_later(_kind, _value))


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP_INFO, written as two runs by lookup time, the first half of which is compacted into the bucketed table."""
    def build():
        rows, path = tables(spark, sf_dir).ip_info, f"{ensure_checkpoint_dir(spark)}/cache-{uuid.uuid4().hex}"
        old = F.col("TS_CODE") <= F.lit(O.TODAY).cast(rows.schema["TS_CODE"].dataType)
        for n, part in enumerate((old, ~old)):
            append_run(rows.where(part).withColumn(EN.LOOKUP_OK, F.lit(True)), path, n)
        LookupCache(spark, path).compact(before=O.TODAY, buckets=8)
        return path

    return LookupCache(spark, _once(spark, ("cache", sf_dir), build)).read()


_enrich_query("ip_cache_hits_compacted", lambda spark, d: EN.cache_hits(compacted(spark, d), conn(spark, d)))
_enrich_query("ip_cache_misses_compacted", lambda spark, d: EN.cache_misses(conn(spark, d), compacted(spark, d)))
_enrich_query("lookups_today_compacted", lambda spark, d: EN.lookup_quota(compacted(spark, d), O.TODAY))


# ----------------------------------------------------------------- access
def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in _REGISTRY.items() if q.sql is not None}
