"""Randomised properties (Hypothesis) against brute force on small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators import cluster as CL
from flowlens.operators import totals as TOT
from flowlens.plans.registry import rounded
from flowlens.schemas import TOTALS
from flowlens.sources import scans
from tests.conftest import conn_row

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _brute_two_means(xs):
    vals = sorted(set(xs))
    if len(vals) == 1:
        return vals[0], 0.0
    best = None
    for t in vals[:-1]:
        lo = [x for x in xs if x <= t]
        hi = [x for x in xs if x > t]
        ml, mh = sum(lo) / len(lo), sum(hi) / len(hi)
        cost = sum((x - ml) ** 2 for x in lo) + sum((x - mh) ** 2 for x in hi)
        if best is None or cost < best[0] - 1e-9 * max(1.0, cost):
            best = (cost, t)
    return best[1], best[0]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=5000), min_size=1, max_size=60))
def test_two_means_exact_is_optimal(spark, xs):
    got = CL.two_means_exact(spark.createDataFrame([(x,) for x in xs], "COUNT long")).first()
    threshold, cost = _brute_two_means(xs)
    assert abs(got.COST - cost) <= 1e-6 * max(1.0, cost)
    if len(set(xs)) > 1:
        # Equal-cost splits may exist; the one chosen must be optimal.
        assert got.K == 2 and got.LOW_N + got.HIGH_N == len(xs)
    else:
        assert got.K == 1 and got.THRESHOLD == threshold


HOSTS = st.sampled_from(["10.0.0.1", "10.0.0.2", "10.0.0.3"])
ROW = st.tuples(
    st.integers(min_value=0, max_value=3 * 3600), HOSTS, st.sampled_from([1000, 1001, 40000]),
    st.sampled_from(["203.0.0.1", "203.0.0.2"]), st.sampled_from([22, 80, 443]),
    st.sampled_from(["tcp", "udp"]), st.sampled_from(["http", "ssh", None]),
    st.one_of(st.none(), st.floats(min_value=0, max_value=100, allow_nan=False)),
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=40))
def test_all_totals_strategies_equal_each_single_total(spark, make_log, rows):
    t0 = dt.datetime(2018, 12, 3)
    log = make_log([
        conn_row(t0 + dt.timedelta(seconds=s), orig=o, orig_p=op, resp=r, resp_p=rp, proto=p, service=sv,
                 duration=d, uid=f"u{i}")
        for i, (s, o, op, r, rp, p, sv, d) in enumerate(rows)
    ])
    conn = scans.scan_conn(log)
    want = None
    for spec in TOTALS:
        part = rounded(TOT.totals(conn, spec))
        want = part if want is None else want.unionByName(part)
    want = want.cache()
    for strategy in ("two_level", "grouping_sets"):
        got = rounded(TOT.totals_all(conn, strategy=strategy))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, strategy
    n = len(rows)
    per_tipo = want.groupBy("TIPO").agg(F.sum("COUNT").alias("c")).collect()
    assert all(r.c == n for r in per_tipo) and len(per_tipo) == len(TOTALS)
    want.unpersist()
