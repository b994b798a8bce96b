"""What outlives a run: merged totals, models, the compacted cache, reserved quotas, sketches."""

import datetime as dt
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import totals as TOT
from flowlens.plans import jobs
from flowlens.plans.registry import rounded
from flowlens.schemas import IP_INFO_SCHEMA
from flowlens.sinks import ResultTable, append_run
from flowlens.sinks.cache import LookupCache
from flowlens.sinks.manifests import Manifests
from flowlens.sinks.models import ModelStore
from flowlens.sinks.quota import QuotaBook
from flowlens.sinks.state import TotalsState
from flowlens.sources import scans
from flowlens.streaming import run_incremental_totals
from flowlens.streaming.incremental import STREAM_TABLE
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 22, 30, 0)
RUN = "2018-12-04 00:00:00"


def folder(name="t"):
    return os.path.join(tempfile.mkdtemp(prefix="flowlens-kept-"), name)


def rows(n, minutes=1, **kw):
    return [conn_row(T0 + dt.timedelta(minutes=minutes * i), uid=f"u{i}", orig=f"10.0.{i % 7}.1", orig_p=i % 3,
                     **({"service": None if i % 5 == 0 else "http"} | kw)) for i in range(n)]


def same(a, b):
    a, b = rounded(a), rounded(b.select(*a.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_ten_runs_and_one_run_give_the_same_totals(spark, make_log, monkeypatch):
    log = make_log(rows(200, minutes=2))  # over midnight
    conn = scans.scan_conn(log)
    state = TotalsState(spark, folder())
    parts = [conn.where(F.pmod(F.xxhash64("UID"), F.lit(10)) == i) for i in range(10)]
    for i, part in enumerate(parts):
        assert state.merge(TOT.totals_all(part), f"RUN_ID={i}")
        if i % 4 == 0:
            assert not state.merge(TOT.totals_all(part), f"RUN_ID={i}")  # a replay changes nothing
    whole = TOT.totals_all(conn)
    assert same(whole, state.read()) and same(whole.where("TIPO = 'PROTO'"), state.read("PROTO"))
    with monkeypatch.context() as m:
        m.setattr(Manifests, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            state.merge(whole, "RUN_ID=99")
    assert same(whole, state.read()) and len(state.applied()) == 10
    # days that a run does not touch stay where they are
    before = state.manifests.newest("STATE")[1]["kinds"]
    late = [conn_row(dt.datetime(2018, 12, 9, 1), uid="late")]
    state.merge(TOT.totals_all(scans.scan_conn(make_log(late))), "RUN_ID=late")
    after = state.manifests.newest("STATE")[1]["kinds"]
    assert len(before) == 2 and after.keys() - before.keys() == {"2018-12-09"} and all(after[d] == before[d] for d in before)
    assert same(TOT.totals_all(scans.scan_conn(make_log(rows(200, minutes=2) + late))), state.read())
    assert state.merge(whole.limit(0), "RUN_ID=none") and not state.merge(whole, "RUN_ID=none")


def test_two_writers_of_the_state_lose_nothing(spark, make_log, monkeypatch):
    path, one, two = folder(), make_log(rows(30)), make_log(rows(20))
    publish, once = Manifests.publish, []

    def late(self, *args):
        if not once:
            once.append(1)
            TotalsState(spark, path).merge(TOT.totals_all(scans.scan_conn(two)), "RUN_ID=2")
        return publish(self, *args)

    monkeypatch.setattr(Manifests, "publish", late)
    state = TotalsState(spark, path)
    assert state.merge(TOT.totals_all(scans.scan_conn(one)), "RUN_ID=1") and sorted(state.applied()) == ["RUN_ID=1", "RUN_ID=2"]
    assert same(TOT.totals_all(scans.scan_conn(one.unionByName(two))), state.read())


def test_jobs_and_streams_merge_their_totals(spark, make_log):
    tables, log_path, ckpt = folder("tables"), folder("LOG"), folder("ckpt")
    log = make_log(rows(40))
    for run in (RUN, RUN, "2018-12-05 00:00:00"):
        jobs.job_totals(log, tables, run_ts=run, merge=True)
    twice = TotalsState(spark, os.path.join(tables, jobs.LOG_TOTAIS_ALL))
    assert twice.read("PROTO").agg(F.sum("COUNT")).first()[0] == 80
    for n in (40, 25):
        make_log(rows(n)).write.mode("append").parquet(log_path)
        run_incremental_totals(spark, log_path, tables, ckpt, merge=True)
    stream = TotalsState(spark, os.path.join(tables, STREAM_TABLE + "_ALL"))
    assert same(TOT.totals_all(scans.scan_conn(spark.read.parquet(log_path))), stream.read())


def test_models_label_later_rows_without_fitting(spark, make_log, monkeypatch):
    tables = folder("tables")
    burst = [conn_row(T0, uid=f"b{i}") for i in range(50)]
    log = make_log(rows(30, service="http") + burst)
    jobs.job_ddos(log, tables, services=("http",), run_ts=RUN)
    later = make_log([conn_row(T0 + dt.timedelta(days=1), uid=f"c{i}", orig="10.9.9.9") for i in range(40)]
                     + [conn_row(T0 + dt.timedelta(days=1, minutes=i), uid=f"d{i}", orig="10.8.8.8") for i in range(3)])
    monkeypatch.setattr(CL, "fit", lambda *a, **k: pytest.fail("nothing is to be fitted"))
    path = jobs.job_label(log.unionByName(later), tables, "ddos", ("http",), since=T0 + dt.timedelta(hours=20), run_ts="2018-12-05 00:00:00")
    new = ResultTable(spark, path).read("http", run_id="latest")
    assert {(r.ID_ORIG_H, r.COUNT, r.IS_HIGH) for r in new.collect()} == {("10.9.9.9", 40, True), ("10.8.8.8", 1, False)}
    old = ResultTable(spark, path).read("http", since="2018-12-03 00:00:00").where("RUN_ID < %d" % jobs.run_id_of("2018-12-05 00:00:00"))
    assert old.first().CENTROID == new.first().CENTROID and old.count() > 2
    store = ModelStore(spark, os.path.join(tables, jobs.LOG_KMEANS_DDOS + "_MODELS"))
    with pytest.raises(ValueError, match="no model for 'ssh'"):
        store.load("ssh")
    store.save(None, "http", jobs.run_id_of("2018-12-06 00:00:00"))  # a later run without rows has no model
    assert store.load("http").stages[-1].getK() == 2


def info(spark, items):
    rows_ = [(ip, f"h{n}" if ok else None, "c", "r", "BR", "o", 1.0, 2.0, t, ok) for n, (ip, t, ok) in enumerate(items)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in IP_INFO_SCHEMA) + ", LOOKUP_OK boolean"
    return spark.createDataFrame(rows_, schema)


def test_compaction_changes_no_answer_and_spares_the_shuffle(spark, make_log):
    path, day = folder("cache"), dt.datetime(2018, 12, 4)
    hour = dt.timedelta(hours=1)
    old = [(f"203.0.0.{i % 30}", day - (5 - i % 3) * hour, i % 4 > 0) for i in range(60)]
    append_run(info(spark, old[:40]), path, 1)
    append_run(info(spark, old[40:]), path, 2)
    append_run(info(spark, [("203.0.0.1", day + hour, True), ("203.0.0.99", day + hour, False)]), path, 3)
    hosts = make_log([conn_row(T0, uid=f"u{i}", resp=f"203.0.0.{i}") for i in range(120)]).select("ID_RESP_H")

    def answers(cache):
        latest = EN.latest_ip_info(cache)
        return [sorted(map(str, df.collect())) for df in (
            latest, EN.cache_hits(cache, hosts), EN.cache_misses(hosts, cache), EN.lookup_quota(cache, day),
            EN.attach_ip_info(hosts, latest, unique=True))]

    cache = LookupCache(spark, path)
    before = answers(cache.read())
    assert cache.compact(day, buckets=8) == 2 and cache.compact(day, buckets=8) == 0
    assert answers(cache.read()) == before and len(cache.vacuum()) == 2 and answers(cache.read()) == before
    assert cache.compact(day + 2 * hour, buckets=8) == 1  # the third run joins the table
    assert answers(cache.read()) == before[:3] + answers(cache.read())[3:4] + before[4:]
    assert cache.read().count() == cache.read().select("IP").distinct().count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (EN.cache_hits(cache.read(), hosts), EN.cache_misses(hosts, cache.read()), EN.attach_ip_info(hosts, EN.latest_ip_info(cache.read()), unique=True)):
            side = [part for part in df._jdf.queryExecution().executedPlan().toString().split("FileScan") if "Bucketed: true" in part]
            assert side
            plan = df._jdf.queryExecution().executedPlan()
            # every shuffle is on the hosts' side: below none is a scan of the cache
            shuffles = [str(n.toString()) for n in exchanges(plan)]
            assert not any("flowlens_ip" in s for s in shuffles)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def exchanges(plan):
    """All shuffles of a plan."""
    out, stack = [], [plan]
    while stack:
        node = stack.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            out.append(node)
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return out


def test_overlapping_runs_keep_to_the_quota(spark, make_log, monkeypatch):
    log = make_log([conn_row(T0, uid=f"u{i}", resp=f"203.0.{i // 200}.{i % 200}") for i in range(300)])
    data, cache = TOT.totals(scans.scan_conn(log), "RESP_H"), info(spark, [])

    def make_client():
        return lambda ips: pd.DataFrame({"HOSTNAME": ["h"] * len(ips)})

    book = QuotaBook(spark, folder("quota"), 100)
    asked = []
    for run in ("a", "b", "a", "c"):  # each starts before another's rows are stored; the second "a" is a rerun
        _, new = EN.enrich(data, cache, make_client=make_client, today="2018-12-04", limit=70, daily_quota=100, run_ts=f"2018-12-04 0{'abc'.index(run)}:00:00", book=book)
        asked.append(0 if new is None else new.count())
    assert asked == [70, 30, 70, 0] and sum(book.reserved("2018-12-04").values()) == 100
    assert book.reserve("2018-12-05", "d", 500) == 100  # another day
    publish, once = Manifests.publish, []

    def late(self, *args):
        if not once:
            once.append(1)
            assert book.reserve("2018-12-06", "first", 60) == 60
        return publish(self, *args)

    monkeypatch.setattr(Manifests, "publish", late)
    assert book.reserve("2018-12-06", "second", 60) == 40


def test_sketches_of_minutes_make_those_of_hours(spark, make_log):
    log = make_log([conn_row(T0.replace(minute=i % 60), uid=f"u{i}", orig="10.0.0.1", resp_p=i % 20_000, service=None) for i in range(40_000)])
    conn = scans.scan_conn(log)
    minutes = MIN.port_sketches(conn, "tcp")
    hour = MIN.distinct_ports(MIN.union_sketches(minutes)).first()
    assert hour.COUNT == 40_000 and abs(hour.DISTINCT_RESP_P - 20_000) < 0.05 * 20_000
    direct = MIN.distinct_ports(conn.groupBy(*MIN.PORT_KEYS).agg(F.hll_sketch_agg("ID_RESP_P", F.lit(MIN.LG_SKETCH)).alias("RESP_P_SKETCH"))).first()
    assert abs(hour.DISTINCT_RESP_P - direct.DISTINCT_RESP_P) <= 0.02 * 20_000
    few = MIN.distinct_ports(MIN.port_sketches(conn.where("ID_RESP_P < 100"), "tcp"))
    exact = MIN.scan_minutes(conn.where("ID_RESP_P < 100"), "tcp", distinct_resp_ports=True).groupBy("ID_ORIG_H", "TS").agg(F.max("DISTINCT_RESP_P").alias("n"))
    assert {(r.TS, r.DISTINCT_RESP_P) for r in few.collect()} == {(r.TS, r.n) for r in exact.collect()}
    assert max(len(r.RESP_P_SKETCH) for r in minutes.collect()) < 10_000


def test_lloyds_fixed_point(spark, make_log):
    log = make_log(rows(60, service="http") + [conn_row(T0, uid=f"b{i}", orig="10.1.1.1", duration=9.0) for i in range(30)])
    data = MIN.ddos_minutes(scans.scan_conn(log), "http")
    features = ("DURATION", "ORIG_PKTS", "ORIG_BYTES")
    for seed in range(3):
        means = CL.centre_means(CL.kmeans_multi(data, features, seed=seed, tol=0.0, max_iter=100), features).collect()
        assert len(means) == 2 and all(r.CENTRE == pytest.approx(r.MEAN) for r in means) and sum(r.N for r in means) == data.count()
