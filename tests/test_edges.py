"""Edge fixtures (a few hand-built rows each), one per decision in SURVEY §1.5."""

import datetime as dt
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import pivot as PV
from flowlens.operators import totals as TOT
from flowlens.operators import web as WEB
from flowlens.plans import exports as X
from flowlens.schemas import IP_INFO_SCHEMA, LOG_COLUMNS, TOTALS_COLUMNS
from flowlens.sinks.tables import read_results, stamp_run, write_results
from flowlens.sources import scans
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)


def _ip_info(spark, rows):
    return spark.createDataFrame(rows, IP_INFO_SCHEMA)


def test_empty_conn_gives_empty_totals_and_kmeans(spark, make_log):
    log = make_log([conn_row(T0)]).limit(0)
    conn = scans.scan_conn(log)
    assert TOT.totals_all(conn).count() == 0
    assert list(TOT.totals_all(conn).columns) == list(TOTALS_COLUMNS)
    res = CL.kmeans(MIN.ddos_minutes(conn, "http"))
    assert res.count() == 0
    assert {"prediction", "CENTROID", "CENTROIDS", "IS_HIGH"} <= set(res.columns)
    assert CL.two_means_exact(MIN.ddos_minutes(conn, "http")).count() == 0


def test_single_distinct_count_gives_one_centre(spark, make_log):
    rows = [conn_row(T0 + dt.timedelta(minutes=m), uid=f"u{m}") for m in range(6)]
    minutes = MIN.ddos_minutes(scans.scan_conn(make_log(rows)), "http")
    res = CL.kmeans(minutes).collect()
    assert len(res) == 6
    assert all(len(r.CENTROID) == 1 and r.CENTROID[0] == "1.0" for r in res)
    exact = CL.two_means_exact(minutes).first()
    assert exact.K == 1 and exact.LOW_CENTER == 1.0 and exact.HIGH_CENTER is None and exact.COST == 0.0


def test_day_labels_sort_chronologically(spark, make_log):
    rows = [
        conn_row(dt.datetime(2018, 11, 30, 23, 0), uid="a"),
        conn_row(dt.datetime(2018, 12, 1, 0, 30), uid="b"),
        conn_row(dt.datetime(2018, 12, 1, 1, 30), uid="c"),
    ]
    totals = TOT.totals(scans.scan_conn(make_log(rows).repartition(3)), "PROTO").repartition(3)
    out = tempfile.mkdtemp(prefix="flowlens-test-")
    X.export_pivot(totals, out, "PROTO_", "PROTO", single_file=True)
    X.export_pivot(totals, out, "MULTI_", "PROTO")
    multi = spark.read.option("header", True).csv(os.path.join(out, "MULTI__PIVOT_H"))
    assert "_bucket" not in multi.columns and multi.count() == 3
    day = spark.read.option("header", True).csv(os.path.join(out, "PROTO__PIVOT_D")).collect()
    assert [r.TS for r in day] == ["30.11.2018", "01.12.2018"]
    hour = spark.read.option("header", True).csv(os.path.join(out, "PROTO__PIVOT_H")).collect()
    assert [r.TS for r in hour] == ["30.11.2018 23", "01.12.2018 00", "01.12.2018 01"]


def test_null_service_is_not_a_rolled_up_service(spark, make_log):
    rows = [conn_row(T0, service=None, uid="a"), conn_row(T0, service="http", uid="b")]
    allt = TOT.totals_all(scans.scan_conn(make_log(rows)))
    service = allt.where(F.col("TIPO") == "SERVICE").collect()
    assert sorted((r.SERVICE or "<null>", r.COUNT) for r in service) == [("<null>", 1), ("http", 1)]
    proto = allt.where(F.col("TIPO") == "PROTO").collect()
    assert [(r.PROTO, r.COUNT) for r in proto] == [("tcp", 2)]


def test_null_pivot_value_column_is_named_null(spark, make_log):
    rows = [conn_row(T0, service=None, uid="a"), conn_row(T0, service="http", uid="b")]
    totals = TOT.totals(scans.scan_conn(make_log(rows)), "SERVICE")
    piv = PV.pivot_counts(totals, "SERVICE", "hour")
    assert set(piv.columns) == {"TS", "null", "http", "OTHER"} and piv.first()["OTHER"] is None
    piv2 = PV.pivot_counts(totals, "SERVICE", "hour", values=["http"])
    assert (piv2.first()["http"], piv2.first()["OTHER"]) == (1, 1)


def test_missing_and_duplicate_ips_keep_each_row_once(spark, make_log):
    rows = [conn_row(T0, resp="203.0.0.1", uid="a"), conn_row(T0, resp="203.0.0.2", uid="b")]
    totals = TOT.totals(scans.scan_conn(make_log(rows)), "RESP_H")
    info = _ip_info(spark, [
        ("203.0.0.1", "old", "c", "r", "BR", "o", 1.0, 2.0, dt.datetime(2018, 12, 1)),
        ("203.0.0.1", "new", "c", "r", "BR", "o", 1.0, 2.0, dt.datetime(2018, 12, 2)),
    ])
    out = EN.attach_ip_info(totals, EN.latest_ip_info(info)).collect()
    assert len(out) == 2
    by_host = {r.ID_RESP_H: r.HOSTNAME for r in out}
    assert by_host == {"203.0.0.1": "new", "203.0.0.2": None}


def test_failed_lookup_keeps_row_with_null_attributes(spark):
    ips = spark.createDataFrame([("203.0.0.1",), ("203.0.0.2",)], "ID_RESP_H string")

    def make_client():
        def fetch(series):
            if (series == "203.0.0.2").any():
                raise RuntimeError("service down")
            return pd.DataFrame({"HOSTNAME": ["h-" + s for s in series], "LATITUDE": ["1.5"] * len(series),
                                 "LONGITUDE": ["bad"] * len(series)})

        return fetch

    # Both IPs in one batch: the failure affects its own IP only.
    res = EN.lookup_with(ips.coalesce(1), make_client, run_ts="2018-12-03 12:00:00")
    got = {r.IP: r for r in res.collect()}
    assert set(got) == {"203.0.0.1", "203.0.0.2"}
    assert got["203.0.0.2"].LOOKUP_OK is False and got["203.0.0.2"].HOSTNAME is None
    assert got["203.0.0.1"].LOOKUP_OK is True and got["203.0.0.1"].LATITUDE == 1.5 and got["203.0.0.1"].LONGITUDE is None
    stored = EN.cache_rows(res)  # the failed attempt is stored, counted and not asked again
    assert stored.count() == 2 and EN.lookup_quota(stored, "2018-12-03", 10).first().FREE == 8
    assert EN.cache_misses(ips, stored).count() == 0
    assert [r.IP for r in EN.latest_ip_info(stored).collect()] == ["203.0.0.1"]


def test_quota_used_up_makes_no_lookup_but_joins_cache(spark, make_log):
    rows = [conn_row(T0, resp="203.0.0.1", uid="a"), conn_row(T0, resp="203.0.0.2", uid="b")]
    totals = TOT.totals(scans.scan_conn(make_log(rows)), "RESP_H")
    today = dt.datetime(2018, 12, 3)
    info = _ip_info(spark, [("203.0.0.1", "h1", "c", "r", "BR", "o", 1.0, 2.0, today + dt.timedelta(hours=1))])
    calls = []

    def make_client():
        calls.append(1)
        return lambda s: pd.DataFrame({"HOSTNAME": list(s)})

    enriched, new = EN.enrich(totals, info, make_client=make_client, today=today, daily_quota=1, limit=1000)
    assert new is not None and new.count() == 0  # empty batch
    assert {r.ID_RESP_H: r.HOSTNAME for r in enriched.collect()} == {"203.0.0.1": "h1", "203.0.0.2": None}
    assert EN.lookup_quota(info, today, 1).first().FREE == 0


def test_rerun_with_same_run_id_keeps_one_copy(spark, make_log):
    rows = [conn_row(T0, uid="a"), conn_row(T0 + dt.timedelta(hours=1), uid="b")]
    res = TOT.totals_all(scans.scan_conn(make_log(rows)))
    path = os.path.join(tempfile.mkdtemp(prefix="flowlens-test-"), "LOG_TOTAIS")
    run1, run2 = "2018-12-03 12:00:00", "2018-12-04 12:00:00"
    write_results(stamp_run(res, run1), path)
    write_results(stamp_run(res, run1), path)
    n = res.count()
    assert read_results(spark, path).count() == n
    write_results(stamp_run(res, run2), path)
    assert read_results(spark, path).count() == 2 * n
    latest = scans.scan_totals(read_results(spark, path), tipo=None, run_id="latest")
    assert latest.count() == n


def test_www_like_is_case_sensitive_substring(spark, make_log):
    rows = []
    for i, q in enumerate(["www.a", "x.www.b", "wwwa", "WWW.a"]):
        r = conn_row(T0, uid=f"u{i}", TIPO="DNS", QUERY=q)
        rows.append(r)
    dns = scans.dns_records(make_log(rows))
    got = sorted(r.QUERY for r in WEB.dns_www(dns).collect())
    assert got == ["www.a", "x.www.b"]


def test_since_is_strict(spark, make_log):
    rows = [conn_row(T0, uid="a"), conn_row(T0 + dt.timedelta(seconds=1), uid="b")]
    log = make_log(rows)
    stamp = (T0 + dt.timedelta(seconds=5)).isoformat(sep=" ")
    assert [r.UID for r in scans.scan_since(log, stamp).collect()] == ["b"]
    assert len(LOG_COLUMNS) == len(log.columns)


def test_record_limit_is_repeatable(spark, make_log):
    rows = [conn_row(T0 + dt.timedelta(seconds=i), uid=f"u{i}") for i in range(10)]
    log = make_log(rows).repartition(4)
    got = [r.UID for r in scans.conn_records(log, limit=3).collect()]
    assert got == ["u0", "u1", "u2"]


def test_results_do_not_depend_on_session_time_zone(spark, sf_dir):
    from flowlens.plans.registry import queries
    from tools.oracle_check import spark_digest

    qs = queries()
    names = ["totals_proto", "pivot_proto_day", "lookups_today", "scan_totals", "ddos_minutes_http"]
    utc = {n: spark_digest(qs[n](spark, sf_dir)) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        other = {n: spark_digest(qs[n](spark, sf_dir)) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc
