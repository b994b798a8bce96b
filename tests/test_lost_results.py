"""Each way in which a job once lost or repeated results."""

import datetime as dt
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlens import session as S
from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import pivot as PV
from flowlens.operators import totals as TOT
from flowlens.plans import exports as X
from flowlens.plans import jobs
from flowlens.plans.registry import queries
from flowlens.schemas import IP_INFO_SCHEMA, TOTALS
from flowlens.sinks import append_run, read_results, stamp_run, write_results
from flowlens.sources import fixtures, scans
from flowlens.streaming import run_incremental_totals
from flowlens.streaming.incremental import STREAM_TABLE
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)
RUN = "2018-12-04 00:00:00"


def _tmp(*names):
    root = tempfile.mkdtemp(prefix="flowlens-lost-")
    return [os.path.join(root, n) for n in names]


def _rows(n, **kw):
    return [conn_row(T0 + dt.timedelta(minutes=i % 7), uid=f"u{i}", orig=f"10.0.{i % 40}.1", **kw) for i in range(n)]


def _csv(spark, out, name):
    return spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(out, name))


def test_new_stream_checkpoint_keeps_the_old_results(spark, make_log):
    log, tables, one, two = _tmp("LOG", "tables", "one", "two")
    make_log(_rows(50)).write.parquet(log)
    run_incremental_totals(spark, log, tables, one)
    run_incremental_totals(spark, log, tables, two)
    stored = read_results(spark, os.path.join(tables, STREAM_TABLE)).where("TIPO = 'PROTO'")
    assert stored.agg(F.sum("COUNT")).first()[0] == 100 and stored.select("QUERY_ID").distinct().count() == 2


def test_latest_run_is_taken_per_kind_and_every_value_is_exported(spark, make_log):
    tables, out = _tmp("tables", "out")
    log = make_log(_rows(40) + _rows(30, service="ssh", resp_p=22) + _rows(20, service="dns", proto="udp"))
    jobs.job_ddos(log, tables, services=("http",), run_ts="2018-12-03 01:00:00")
    jobs.job_ddos(log, tables, services=("ssh", "dns"), run_ts="2018-12-03 02:00:00")
    jobs.job_export(spark, tables, out)
    for v, n in (("http", 40), ("ssh", 30), ("dns", 20)):
        got = spark.read.json(os.path.join(out, f"DDoS_{v}"))
        assert got.agg(F.sum("COUNT")).first()[0] == n
        assert _csv(spark, out, f"DDoS_{v}_LONG_M").agg(F.sum("COUNT")).first()[0] == n
    assert _csv(spark, out, "GRF_DDOS_IP_LONG_M").agg(F.sum("COUNT")).first()[0] == 90


def test_pivot_cells_add_up_whatever_the_columns(spark, make_log):
    (out,) = _tmp("out")
    totals = TOT.totals(scans.scan_conn(make_log(_rows(400))), "ORIG_H")
    X.export_pivot(totals, out, "P", "ID_ORIG_H", units=("hour",), most=3)
    wide = _csv(spark, out, "P_PIVOT_H")
    assert len(wide.columns) == 5 and sum(sum(v for v in r[1:] if v is not None) for r in wide.collect()) == 400
    assert _csv(spark, out, "P_LONG_H").agg(F.sum("COUNT")).first()[0] == 400
    none = PV.pivot_counts(totals, "ID_ORIG_H", values=[])
    assert none.agg(F.sum("OTHER")).first()[0] == 400


def test_empty_rerun_removes_its_old_rows_only(spark, make_log):
    (tables,) = _tmp("tables")
    log = make_log(_rows(30))
    for run in (RUN, "2018-12-05 00:00:00"):
        jobs.job_totals(log, tables, run_ts=run)
        jobs.job_ddos(log, tables, services=("http",), run_ts=run)
    jobs.job_totals(log.limit(0), tables, run_ts=RUN)
    jobs.job_ddos(log.limit(0), tables, services=("http",), run_ts=RUN)
    for t in (jobs.LOG_TOTAIS, jobs.LOG_KMEANS_DDOS):
        assert {r.TS_CODE for r in read_results(spark, os.path.join(tables, t)).collect()} == {dt.datetime(2018, 12, 5)}


def test_result_files_follow_the_data_not_the_tasks(spark, make_log):
    (path,) = _tmp("t")
    res = stamp_run(TOT.totals_all(scans.scan_conn(make_log(_rows(300)).repartition(8))), RUN)
    write_results(res, path)
    assert all(len([f for f in files if f.endswith(".parquet")]) <= 2 for _, _, files in os.walk(path))


def test_cache_grows_at_its_own_path_once_per_run(spark, make_log):
    tables, out, cache = _tmp("tables", "out", "cache")
    rows = [conn_row(T0, uid=f"u{i}", resp=f"203.0.0.{i}") for i in range(6)]
    jobs.job_totals(make_log(rows), tables, run_ts=RUN)
    info = spark.createDataFrame([("203.0.0.1", "h", "c", "r", "BR", "o", 1.0, 2.0, T0)], IP_INFO_SCHEMA)
    append_run(info.withColumn("LOOKUP_OK", F.lit(True)), cache, 0)

    def make_client():
        return lambda ips: pd.DataFrame({"HOSTNAME": ["h-" + i for i in ips]})

    for _ in range(2):  # the rerun replaces its own partition
        jobs.job_export(spark, tables, out, ip_info=cache, make_client=make_client, today="2018-12-04", run_ts=RUN)
        stored = spark.read.parquet(cache)
        assert stored.select("IP").distinct().count() in (1, 6)
    jobs.job_export(spark, tables, out, ip_info=cache, make_client=make_client, today="2018-12-04", run_ts="2018-12-04 09:00:00")
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("IP").distinct().count() == 6
    plain = os.path.join(tables, "plain")
    info.write.parquet(plain)
    with pytest.raises(ValueError, match="RUN_ID"):
        jobs.job_export(spark, tables, out, ip_info=plain, make_client=make_client)


def test_directory_join_has_no_quota(spark, make_log):
    rows = [conn_row(T0, uid=f"u{i}", resp=f"203.0.{i // 200}.{i % 200}") for i in range(1500)]
    totals = TOT.totals(scans.scan_conn(make_log(rows)), "RESP_H")
    directory = totals.select(F.col("ID_RESP_H").alias("IP")).selectExpr(
        "IP", "'h' HOSTNAME", "'c' CITY", "'r' REGION", "'BR' COUNTRY", "'o' ORG", "1.0D LATITUDE", "2.0D LONGITUDE")
    enriched, new = EN.enrich(totals, spark.createDataFrame([], IP_INFO_SCHEMA), directory=directory, run_ts=RUN)
    assert enriched.where("HOSTNAME = 'h'").count() == 1500 == new.count()


def test_missing_tables_are_named_and_skipped(spark, caplog):
    tables, out = _tmp("tables", "out")
    assert jobs.job_export(spark, tables, out) == []
    assert "LOG_TOTAIS" in caplog.text and jobs.LOG_KMEANS_DDOS in caplog.text


def test_one_centre_is_never_high_and_cost_uses_the_models_centres(spark, make_log):
    one = CL.kmeans(MIN.ddos_minutes(scans.scan_conn(make_log([conn_row(T0 + dt.timedelta(minutes=i), uid=f"u{i}") for i in range(5)])), "http"))
    assert {r.IS_HIGH for r in one.collect()} == {False}
    data = spark.createDataFrame([(float(i), float(i * i % 17), float(i % 5)) for i in range(60)], "a double, b double, c double")
    got = CL.kmeans(data, features=("a", "b", "c"), max_iter=1).collect()
    centres = got[0].CENTROIDS
    want = sum(sum((x - y) ** 2 for x, y in zip((r.a, r.b, r.c), centres[r.prediction])) for r in got)
    cost = CL.kmeans_cost(spark.createDataFrame(got), ("a", "b", "c")).first().WSSSE
    assert len(centres[0]) == 3 and abs(cost - want) < 1e-6


def test_jobs_report_their_cost(spark, make_log):
    (tables,) = _tmp("tables")
    metrics = {}
    jobs.job_ddos(make_log(_rows(60)), tables, services=("http",), run_ts=RUN, metrics=metrics)
    assert metrics["rows"] > 0 and metrics["wssse"]["http"] >= 0


def test_two_means_takes_any_feature(spark):
    values = [-5.0, -4.0, 0.0, 0.0, 0.1, 900.0, 1000.0, 1100.0] + [float(x) / 1000 for x in range(600)]
    got = CL.two_means_exact(spark.createDataFrame([(v,) for v in values], "x double"), "x").first()
    cost = lambda part: sum((v - sum(part) / len(part)) ** 2 for v in part)
    want = min(cost(sorted(values)[:i]) + cost(sorted(values)[i:]) for i in range(1, len(values)))
    assert (got.LOW_N, got.HIGH_N) == (605, 3) and abs(got.COST - want) < 1e-6


def test_a_cluster_without_a_shared_folder_raises():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S._local_folder("spark://master:7077")
    with pytest.raises(ValueError):
        S._local_folder("local-cluster[2,1,1024]")
    assert os.path.isdir(S._local_folder("local[4]"))


def test_plans_hold_no_needless_exchange(spark, sf_dir):
    def plan(name):
        return queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

    assert "Exchange hashpartitioning" not in plan("scan_log_since")
    assert "Exchange" not in plan("scan_log_since") and "Exchange" not in plan("top_consumers")
    assert plan("totals_resp_h").count("Exchange hashpartitioning") == 1
    p = plan("scan_totals")
    assert "Expand" not in p and "PartitionFilters" in p and "TIPO" in p.split("PartitionFilters")[1][:200]


@pytest.mark.parametrize("tipo", [t.tipo for t in TOTALS])
def test_each_totals_export_is_in_its_order(spark, sf_dir, tipo):
    (out,) = _tmp("out")
    spec = next(t for t in TOTALS if t.tipo == tipo)
    totals = TOT.totals(scans.scan_conn(fixtures.load(spark, sf_dir).log, "2018-12-03 00:45:00"), spec)
    X.export_totals(totals, out, tipos=[tipo], single_file=True)
    got = [tuple(str(r[c]) if c == "TS" else r[c] for c in spec.export_sort) for r in _csv(spark, out, tipo).collect()]
    key = lambda t: tuple((v is not None, v if v is not None else "") for v in t)
    assert got and got == sorted(got, key=key)
