"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3).  Each query is executed to
completion with the ``noop`` sink (full plan, no collect); the reported
time per query is the median of the warm runs, after one unmeasured pass
over all queries and WARMUP more unmeasured runs of that query (the JVM
needs them to compile Spark's and the generated code).

``calibration_sec`` is the time of a fixed Spark job without input, before and after the
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

WARMUP = 1

HEADLINE = (
    "totals_all",
    "totals_resp_h",
    "conn_by_dns_query",
    "www_totals",
    "top_consumers",
    "ddos_minutes_http",
    "scan_minutes_tcp",
    "two_means_exact_http",
    "kmeans_ddos_http",
    "export_resp_h_info",
    "pivot_http_orig_hour",
    "pivot_scan_tcp_minute",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(HEADLINE)

    from flowlens.plans.registry import queries
    from flowlens.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def calibrate() -> float:
        """Seconds of hashing and grouping 20 million numbers: eight tasks, one shuffle."""
        rows = spark.range(0, 20_000_000, 1, 8).selectExpr("pmod(xxhash64(id), 100000) AS k", "id")
        t0 = time.perf_counter()
        rows.groupBy("k").agg({"id": "sum"}).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # one pass over everything: the JVM compiles Spark's own hot code
        run(name)
    for _ in range(WARMUP):
        calibrate()
    fixed = [calibrate() for _ in range(runs)]
    times = {}
    for name in names:
        for _ in range(WARMUP):  # this query's generated code
            run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    fixed += [calibrate() for _ in range(runs)]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "calibration_sec": round(statistics.median(fixed), 4),
    }))


if __name__ == "__main__":
    main()
