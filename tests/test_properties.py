"""Properties over the fixture tables, and plan shape checks."""

import os
import tempfile

from pyspark.sql import functions as F

from flowlens.functions.time import bucket
from flowlens.operators import cluster as CL
from flowlens.operators import enrich as EN
from flowlens.operators import minutes as MIN
from flowlens.operators import totals as TOT
from flowlens.schemas import TOTALS
from flowlens.sources import fixtures, scans


def _conn(spark, sf_dir):
    return scans.scan_conn(fixtures.load(spark, sf_dir).log, fixtures.DEFAULT_SINCE)


def test_each_total_counts_every_connection_per_hour(spark, sf_dir):
    conn = _conn(spark, sf_dir)
    per_hour = {r.TS: r.n for r in conn.groupBy(bucket(conn, "TS", "hour").alias("TS")).agg(F.count("*").alias("n")).collect()}
    allt = TOT.totals_all(conn)
    sums = allt.groupBy("TIPO", "TS").agg(F.sum("COUNT").alias("c")).collect()
    assert len({r.TIPO for r in sums}) == len(TOTALS)
    for r in sums:
        assert r.c == per_hour[r.TS], (r.TIPO, r.TS)


def test_grouping_sets_equal_single_totals(spark, sf_dir):
    # Double sums are compared at 4 places: the two-level plan adds them in
    # a different order.
    from flowlens.plans.registry import rounded

    conn = _conn(spark, sf_dir).cache()
    allt = rounded(TOT.totals_all(conn)).cache()
    for spec in TOTALS:
        one = rounded(TOT.totals(conn, spec))
        part = allt.where(F.col("TIPO") == spec.tipo)
        assert one.exceptAll(part).count() == 0 and part.exceptAll(one).count() == 0, spec.tipo
    for strategy in ("union", "grouping_sets"):
        other = rounded(TOT.totals_all(conn, strategy=strategy))
        assert other.exceptAll(allt).count() == 0 and allt.exceptAll(other).count() == 0, strategy
    allt.unpersist()
    conn.unpersist()


def test_hits_plus_misses_equal_distinct_hosts(spark, sf_dir):
    t = fixtures.load(spark, sf_dir)
    conn = scans.scan_conn(t.log, fixtures.DEFAULT_SINCE)
    hosts = EN.distinct_hosts(conn).count()
    assert EN.cache_hits(t.ip_info, conn).count() + EN.cache_misses(conn, t.ip_info).count() == hosts


def test_exact_two_means_is_no_worse_than_mllib(spark):
    conn = _conn(spark, "/root/testdata/sf0.01")
    for service in ("http", "ssh"):
        minutes = MIN.ddos_minutes(conn, service)
        exact = CL.two_means_exact(minutes).first()
        assigned = CL.kmeans(minutes, checkpoint=False)
        cost = CL.kmeans_cost(assigned).first().WSSSE
        assert exact.COST <= cost * (1 + 1e-9) + 1e-6
        centres = sorted(c[0] for c in assigned.first().CENTROIDS)
        assert abs(centres[0] - exact.LOW_CENTER) < 1e-6 and abs(centres[-1] - exact.HIGH_CENTER) < 1e-6


def test_silhouette_matches_spark_evaluator(spark, sf_dir):
    minutes = MIN.ddos_minutes(_conn(spark, "/root/testdata/sf0.01"), "http")
    assigned = CL.kmeans(minutes, checkpoint=False).cache()
    ours = CL.silhouette(assigned).first().SILHOUETTE
    theirs = CL.silhouette_evaluator(assigned)
    assigned.unpersist()
    assert abs(ours - theirs) < 1e-9


def test_two_means_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    xs = [rnd.choice([1, 2, 3, 50, 51, 52, 400, 1000, 0]) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "COUNT long")
    got = CL.two_means_exact(df).first()
    best = None
    vals = sorted(set(xs))
    for t in vals[:-1]:
        lo = [x for x in xs if x <= t]
        hi = [x for x in xs if x > t]
        ml, mh = sum(lo) / len(lo), sum(hi) / len(hi)
        cost = sum((x - ml) ** 2 for x in lo) + sum((x - mh) ** 2 for x in hi)
        if best is None or cost < best[0] - 1e-9:
            best = (cost, t)
    assert got.THRESHOLD == best[1]
    assert abs(got.COST - best[0]) < 1e-6 * max(1.0, best[0])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_plans_scan_pruned_and_filtered(spark, sf_dir):
    # Materialise LOG as a table partitioned by TIPO, as a deployment would.
    path = os.path.join(tempfile.mkdtemp(prefix="flowlens-test-"), "LOG")
    fixtures.load(spark, sf_dir).log.write.partitionBy("TIPO").parquet(path)
    log = spark.read.parquet(path)
    conn = scans.scan_conn(log, fixtures.DEFAULT_SINCE)
    plan = _plan(TOT.totals_all(conn, strategy="grouping_sets"))
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    assert "PartitionFilters: [isnotnull(TIPO" in plan and "(TIPO#" in plan
    assert "PushedFilters: [IsNotNull(TS_CODE), GreaterThan(TS_CODE" in plan
    # two_level: one Expand over the input for the 6 port sets, one plain
    # aggregate to the base grain, one Expand over that base.
    plan2 = _plan(TOT.totals_all(conn, strategy="two_level"))
    assert plan2.count("FileScan parquet") == 2 and plan2.count("Expand") == 2
    assert "ReadSchema: struct<TS_CODE" in plan2 and "QUERY" not in plan2.split("ReadSchema")[1].split("\n")[0]
