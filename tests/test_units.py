"""Unit tests for sources, sinks and options not covered by the oracle queries."""

import datetime as dt
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import totals as TOT
from flowlens.plans import exports as X
from flowlens.sinks import read_results, stamp_run, write_csv, write_results
from flowlens.sources import Catalog, TableSource, scans
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)


def _tmp():
    return tempfile.mkdtemp(prefix="flowlens-unit-")


def test_catalog_reads_and_registers(spark, make_log):
    path = os.path.join(_tmp(), "LOG")
    make_log([conn_row(T0, uid="a")]).write.parquet(path)
    cat = Catalog({"log": path}).add("log_csv", TableSource(path, "parquet"))
    assert "LOG" in cat and cat.names() == ["LOG", "LOG_CSV"]
    assert cat.read(spark, "LOG").count() == 1
    cat.register_views(spark)
    assert spark.sql("SELECT COUNT(*) AS n FROM LOG").first().n == 1


def test_scan_results_uncounted(spark):
    df = spark.createDataFrame(
        [("RESP_H", T0, None), ("RESP_H", T0, 3), ("PROTO", T0, None)], "TIPO string, TS_CODE timestamp_ntz, COUNT long")
    got = scans.scan_results_uncounted(df, "RESP_H", since="2018-12-03 00:00:00").collect()
    assert len(got) == 1 and got[0].COUNT is None


def test_row_id_is_unique(spark, make_log):
    rows = [conn_row(T0 + dt.timedelta(minutes=i), uid=f"u{i}") for i in range(50)]
    res = stamp_run(TOT.totals_all(scans.scan_conn(make_log(rows))), "2018-12-03 12:00:00", since=T0, row_id=True)
    assert res.select("ROW_ID").distinct().count() == res.count()
    first = res.first()
    assert first.RUN_ID == 1543838400000 and first.TS_FILTRO == 1543831200000


def test_kmeans_multi_leaves_out_null_features(spark, make_log):
    rows = [conn_row(T0 + dt.timedelta(minutes=i), uid=f"u{i}", duration=None if i % 3 == 0 else float(i))
            for i in range(12)]
    minutes = MIN.ddos_minutes(scans.scan_conn(make_log(rows)), "http")
    res = CL.kmeans_multi(minutes, checkpoint=False)
    assert res.count() == 8
    assert len(res.first().CENTROID) == 2 and res.first().CENTROID[0].count(",") == 2


def test_scan_minutes_distinct_ports_counts_rows_and_ports(spark, make_log):
    rows = [conn_row(T0, uid=f"u{p}", resp_p=p, orig_p=5000) for p in (1, 2, 3, 3)]
    got = MIN.scan_minutes(scans.scan_conn(make_log(rows)), "tcp", distinct_resp_ports=True).first()
    assert got.COUNT == 4 and got.DISTINCT_RESP_P == 3


def test_directory_lookup_marks_unknown(spark):
    batch = spark.createDataFrame([("203.0.0.1",), ("203.0.0.9",)], "ID_RESP_H string")
    directory = spark.createDataFrame([("203.0.0.1", "h1", "c", "r", "BR", "o", 1.0, 2.0)],
                                      "IP string, HOSTNAME string, CITY string, REGION string, COUNTRY string, "
                                      "ORG string, LATITUDE double, LONGITUDE double")
    got = {r.IP: r for r in EN.lookup(batch, directory, run_ts="2018-12-03 12:00:00").collect()}
    assert got["203.0.0.1"].LOOKUP_OK and got["203.0.0.1"].HOSTNAME == "h1"
    assert not got["203.0.0.9"].LOOKUP_OK and got["203.0.0.9"].HOSTNAME is None
    assert EN.cache_rows(EN.lookup(batch, directory)).where("LOOKUP_OK").count() == 1
    twice = directory.unionByName(directory.withColumn("HOSTNAME", F.lit("z9")))
    assert {r.HOSTNAME for r in EN.lookup(batch, twice).collect()} == {"z9", None}  # the same row each time


def test_totals_export_uses_each_sort_order(spark, make_log):
    rows = [conn_row(T0, uid="a", resp="203.0.0.2", resp_p=80, orig="10.0.0.9"),
            conn_row(T0, uid="b", resp="203.0.0.1", resp_p=443, orig="10.0.0.1"),
            conn_row(T0, uid="c", resp="203.0.0.1", resp_p=22, orig="10.0.0.5")]
    totals = TOT.totals_all(scans.scan_conn(make_log(rows)))
    out = _tmp()
    X.export_totals(totals, out, tipos=["RESP_H_P_ORIG_H"], single_file=True)
    got = spark.read.option("header", True).csv(os.path.join(out, "RESP_H_P_ORIG_H")).collect()
    assert [(r.ID_RESP_H, r.ID_RESP_P) for r in got] == [("203.0.0.1", "22"), ("203.0.0.1", "443"), ("203.0.0.2", "80")]


def test_single_file_csv(spark, make_log):
    df = make_log([conn_row(T0 + dt.timedelta(seconds=i), uid=f"u{i}") for i in range(20)]).repartition(4)
    path = os.path.join(_tmp(), "x")
    write_csv(df.select("UID", "TS"), path, order=[F.col("TS")], single_file=True)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1


def test_empty_result_writes_no_partition(spark, make_log):
    path = os.path.join(_tmp(), "LOG_TOTAIS")
    empty = TOT.totals_all(scans.scan_conn(make_log([conn_row(T0)]).limit(0)))
    write_results(stamp_run(empty, "2018-12-03 12:00:00"), path)
    assert not [d for d in os.listdir(path) if d.startswith("TIPO=")]
    full = TOT.totals_all(scans.scan_conn(make_log([conn_row(T0)])))
    metrics = {}
    write_results(stamp_run(full, "2018-12-03 12:00:00"), path, metrics=metrics)
    assert read_results(spark, path).count() == 21 == metrics["rows"]


def test_function_lookup_calls_the_service_once_per_ip(spark, make_log):
    rows = [conn_row(T0 + dt.timedelta(minutes=i), resp=f"203.0.0.{i % 5}", uid=f"u{i}") for i in range(20)]
    totals = TOT.totals(scans.scan_conn(make_log(rows)), "RESP_H")
    info = spark.createDataFrame([], "IP string, HOSTNAME string, CITY string, REGION string, COUNTRY string, "
                                     "ORG string, LATITUDE double, LONGITUDE double, TS_CODE timestamp_ntz")
    looked_up = spark.sparkContext.accumulator(0)

    def make_client():
        def fetch(ips):
            looked_up.add(len(ips))
            return pd.DataFrame({"HOSTNAME": ["h-" + ip for ip in ips]})

        return fetch

    enriched, new = EN.enrich(totals, info, make_client=make_client, today="2018-12-03", limit=1000)
    assert {r.ID_RESP_H: r.HOSTNAME for r in enriched.collect()} == {f"203.0.0.{i}": f"h-203.0.0.{i}" for i in range(5)}
    assert new.count() == 5
    enriched.count()
    assert looked_up.value == 5  # one call per IP although both outputs were computed
