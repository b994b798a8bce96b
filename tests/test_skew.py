"""A hot key holding a third of the rows: AQE splits it, results stay whole."""

import datetime as dt

from flowlens.operators import web as WEB
from flowlens.plans.registry import rounded
from flowlens.sources import scans
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _log(make_log, n=600):
    rows = []
    for i in range(n):
        uid = "HOT" if i % 3 == 0 else f"C{i}"
        rows.append(conn_row(T0 + dt.timedelta(seconds=i), uid=uid, orig_p=1024 + i, resp=f"203.0.0.{i % 50}"))
        if i % 3 != 0 or i < 3:
            rows.append(conn_row(T0 + dt.timedelta(seconds=i), uid=uid, TIPO="DNS", QUERY=f"www.site{i % 7}.example",
                                 service=None))
    return make_log(rows)


def test_hot_uid_is_split_and_results_are_whole(spark, make_log):
    log = _log(make_log).cache()
    conn, dns = scans.conn_records(log), WEB.dns_www(scans.dns_records(log))
    want = rounded(WEB.conn_by_dns_query(conn, dns)).collect()
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = rounded(WEB.conn_by_dns_query(conn, dns))
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()  # final adaptive plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        log.unpersist()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(got) == 200 + 2 * 0 + sum(1 for i in range(600) if i % 3 != 0)  # hot UID: 200 conns x 1 name
    assert "SortMergeJoin" in plan and "skew=true" in plan
