"""Runs are published as a whole, found by their manifests, and exported in one pass."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from flowlens.operators import minutes as MIN
from flowlens.operators import totals as TOT
from flowlens.plans import exports as X
from flowlens.plans import jobs
from flowlens.schemas import TOTALS
from flowlens.sinks import ResultTable, read_results, stamp_run, write_results
from flowlens.sinks.manifests import Manifests
from flowlens.sinks.tables import run_id_of
from flowlens.sources import fixtures, scans
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)
RUN, LATER = "2018-12-04 00:00:00", "2018-12-05 00:00:00"


def folder(name="t"):
    return os.path.join(tempfile.mkdtemp(prefix="flowlens-runs-"), name)


def rows(n, **kw):
    return [conn_row(T0 + dt.timedelta(minutes=i % 7), uid=f"u{i}", orig=f"10.0.{i % 40}.1", **kw) for i in range(n)]


def totals(make_log, n, run, kinds=("PROTO", "SERVICE", "RESP_H")):
    conn = scans.scan_conn(make_log(rows(n)))
    out = TOT.totals(conn, kinds[0])
    for k in kinds[1:]:
        out = out.unionByName(TOT.totals(conn, k))
    return stamp_run(out, run)


def counts(spark, path):
    return {(r.TIPO, r.RUN_ID): r.n for r in read_results(spark, path).groupBy("TIPO", "RUN_ID").agg(F.sum("COUNT").alias("n")).collect()}


def test_a_job_that_ends_before_publishing_leaves_the_old_run_whole(spark, make_log, monkeypatch):
    path, run = folder(), run_id_of(RUN)
    write_results(totals(make_log, 30, RUN), path, replaces={"RUN_ID": run})
    before = counts(spark, path)
    reader = read_results(spark, path)  # resolved now, read later
    with monkeypatch.context() as m:
        m.setattr(Manifests, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            write_results(totals(make_log, 50, RUN, kinds=("PROTO",)), path, replaces={"RUN_ID": run})
    assert counts(spark, path) == before == {(k, run): 30 for k in ("PROTO", "SERVICE", "RESP_H")}
    write_results(totals(make_log, 50, RUN, kinds=("PROTO",)), path, replaces={"RUN_ID": run})
    assert counts(spark, path) == {("PROTO", run): 50}  # the kinds that got no row are gone with the run
    assert reader.agg(F.sum("COUNT")).first()[0] == 90  # a reader that began before still sees the old run


def test_a_failed_write_is_never_seen(spark, make_log):
    path = folder()
    write_results(totals(make_log, 30, RUN), path, replaces={"RUN_ID": run_id_of(RUN)})
    bad = totals(make_log, 30, RUN).withColumn("COUNT", F.when(F.col("COUNT") > 0, F.raise_error(F.lit("broken"))).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        write_results(bad, path, replaces={"RUN_ID": run_id_of(RUN)})
    assert set(counts(spark, path).values()) == {30}


def test_one_kind_is_replaced_and_two_writers_keep_both(spark, make_log, monkeypatch):
    path, run = folder(), run_id_of(RUN)
    write_results(totals(make_log, 10, RUN, ("PROTO",)), path, replaces={"TIPO": "PROTO", "RUN_ID": run})
    publish, once = Manifests.publish, []

    def late(self, *args):
        if not once:  # another writer publishes its kind first
            once.append(1)
            write_results(totals(make_log, 20, RUN, ("SERVICE",)), path, replaces={"TIPO": "SERVICE", "RUN_ID": run})
        return publish(self, *args)

    monkeypatch.setattr(Manifests, "publish", late)
    write_results(totals(make_log, 15, RUN, ("PROTO",)), path, replaces={"TIPO": "PROTO", "RUN_ID": run})
    assert counts(spark, path) == {("PROTO", run): 15, ("SERVICE", run): 20}
    assert Manifests(spark, path).newest(f"RUN_ID={run}")[0] == 3
    write_results(totals(make_log, 15, RUN, ("PROTO",)).limit(0), path, replaces={"TIPO": "PROTO", "RUN_ID": run})
    assert counts(spark, path) == {("SERVICE", run): 20}


def test_newest_run_of_each_kind_by_manifests(spark, make_log):
    path = folder()
    write_results(totals(make_log, 30, RUN), path, replaces={"RUN_ID": run_id_of(RUN)})
    write_results(totals(make_log, 40, LATER, ("PROTO",)), path, replaces={"RUN_ID": run_id_of(LATER)})
    table = ResultTable(spark, path)
    latest = {r.TIPO: r.n for r in table.read(run_id="latest").groupBy("TIPO").agg(F.sum("COUNT").alias("n")).collect()}
    assert latest == {"PROTO": 40, "SERVICE": 30, "RESP_H": 30}
    assert {(r.TIPO, r.RUN_ID) for r in table.runs().collect()} == set(counts(spark, path))
    one = scans.scan_totals(table, tipo="SERVICE", run_id="latest")
    assert one.agg(F.sum("COUNT")).first()[0] == 30
    files = one.inputFiles()
    assert files and all(f"RUN_ID={run_id_of(RUN)}" in f and "TIPO=SERVICE" in f for f in files)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    assert scans.scan_totals(table, since=RUN, tipo=None).select("RUN_ID").distinct().collect()[0][0] == run_id_of(LATER)
    assert scans.scan_totals(table, since=LATER, tipo="PROTO").isEmpty()
    assert table.read("PROTO", run_id=run_id_of(RUN)).agg(F.sum("COUNT")).first()[0] == 30
    with pytest.raises(ValueError, match="no run"):
        read_results(spark, folder())


def test_columns_may_be_added_by_later_runs(spark, make_log):
    path = folder()
    write_results(totals(make_log, 5, RUN), path, replaces={"RUN_ID": run_id_of(RUN)})
    write_results(totals(make_log, 5, LATER).withColumn("MORE", F.lit(1)), path, replaces={"RUN_ID": run_id_of(LATER)})
    got = {(r.RUN_ID, r.MORE) for r in read_results(spark, path).select("RUN_ID", "MORE").distinct().collect()}
    assert got == {(run_id_of(RUN), None), (run_id_of(LATER), 1)}


def test_vacuum_keeps_what_is_named_or_young(spark, make_log):
    path = folder()
    for n in (3, 4, 5):
        write_results(totals(make_log, n, RUN), path, replaces={"RUN_ID": run_id_of(RUN)})
    m = Manifests(spark, path)
    assert m.vacuum() == []
    assert len(m.vacuum(older_than_ms=-60_000)) == 2
    assert set(counts(spark, path).values()) == {5} and m.newest(f"RUN_ID={run_id_of(RUN)}")[0] == 3
    write_results(totals(make_log, 6, RUN), path, replaces={"RUN_ID": run_id_of(RUN)})
    assert set(counts(spark, path).values()) == {6}


def jobs_of(spark, work):
    """The number of Spark jobs that ``work`` runs."""
    sc, group = spark.sparkContext, f"g{os.urandom(4).hex()}"
    sc.setJobGroup(group, "counted")
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_all_totals_are_one_write_in_their_orders(spark, sf_dir):
    out = folder("out")
    found = TOT.totals_all(scans.scan_conn(fixtures.load(spark, sf_dir).log, "2018-12-03 00:45:00"))
    few = jobs_of(spark, lambda: X.export_totals(found, folder("few"), tipos=["PROTO", "SERVICE"]))
    assert jobs_of(spark, lambda: X.export_totals(found, out)) <= few + 1
    assert sorted(os.listdir(out)) == sorted(t.tipo for t in TOTALS)
    key = lambda t: tuple((v is not None, v if v is not None else "") for v in t)
    per_tipo = {r.TIPO: r["count"] for r in found.groupBy("TIPO").count().collect()}
    for spec in TOTALS:
        files = sorted(f for f in os.listdir(os.path.join(out, spec.tipo)) if f.startswith("part-"))
        got = []
        for f in files:  # in the order of the files
            part = spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(out, spec.tipo, f))
            got += [tuple(str(r[c]) if c == "TS" else r[c] for c in spec.export_sort) for r in part.collect()]
        assert got == sorted(got, key=key) and len(got) == per_tipo[spec.tipo]
        assert "TIPO" in part.columns and not any(c.startswith("_") for c in part.columns)


def test_exports_of_values_do_not_add_jobs(spark, make_log):
    def results(values):
        log = make_log([r for v in values for r in rows(12, service=v)])
        return MIN.minutes_for(scans.scan_conn(log), "ddos", values).withColumn("prediction", F.lit(0))

    two, many = ["http", "a/b=c d"], [f"s{i}" for i in range(12)] + [None]
    out = folder("out")
    few = jobs_of(spark, lambda: X.export_kmeans(results(two), out, "DDoS_", "SERVICE"))
    assert jobs_of(spark, lambda: X.export_kmeans(results(many[:-1]), folder("many"), "D_", "SERVICE")) <= few + 3
    assert not [n for n in os.listdir(out) if n.startswith("_")]
    assert spark.read.json(os.path.join(out, "DDoS_http")).agg(F.sum("COUNT")).first()[0] == 12
    wide = spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(out, "DDoS_http_PIVOT_H"))
    assert sum(v for r in wide.collect() for v in r[1:] if v is not None) == 12
    X.export_totals(TOT.totals_all(scans.scan_conn(make_log(rows(3)))), out, tipos=["PROTO"])
    X.export_totals(TOT.totals_all(scans.scan_conn(make_log(rows(3)).limit(0))), out, tipos=["PROTO"])
    assert "PROTO" not in os.listdir(out)  # an export without rows replaces the old one, too


def test_job_export_reads_tables_by_their_manifests(spark, make_log):
    tables, out = folder("tables"), folder("out")
    log = make_log(rows(30) + rows(20, service="ssh", resp_p=22))
    for run in (RUN, LATER):
        jobs.job_totals(log, tables, run_ts=run)
        jobs.job_ddos(log, tables, run_ts=run)
    jobs.job_export(spark, tables, out)
    got = spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(out, "PROTO"))
    assert got.agg(F.sum("COUNT")).first()[0] == 50
