"""What one task holds: few groups of the totals, one shuffle of a stored run, partitions that follow the data."""

import datetime as dt
import re

from flowlens.operators import totals as TOT
from flowlens.plans import jobs, registry
from flowlens.schemas import TOTALS
from flowlens.session import RUNTIME_CONF
from flowlens.sinks import read_results
from flowlens.sinks.state import TotalsState
from flowlens.sources import scans
from tests.conftest import conn_row

T0 = dt.datetime(2018, 12, 3, 10, 0, 0)


def _log(make_log, n=60):
    return make_log([conn_row(T0 + dt.timedelta(minutes=7 * i), orig=f"10.0.0.{i % 5}", orig_p=1000 + i % 11, resp=f"203.0.0.{i % 3}", resp_p=80 + i % 2,
                              service=(None, "http", "dns")[i % 3], uid=f"C{i}") for i in range(n)])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_task_holds_the_groups_of_few_totals(make_log):
    conn = scans.scan_conn(_log(make_log))
    kinds = [s.tipo for f in TOT.families() for s in f]
    assert sorted(kinds) == sorted(s.tipo for s in TOTALS)
    found = TOT.totals_all(conn)
    plan = found._jdf.queryExecution().executedPlan().toString()
    expands = re.findall(r"Expand \[(.*)\], \[", plan)
    assert expands and max(e.count("], [") + 1 for e in expands) <= 3  # 21 rows of an input row before
    assert _same(found, TOT.totals_all(conn, strategy="grouping_sets"))


def test_families_of_any_choice_of_totals(make_log):
    conn = scans.scan_conn(_log(make_log, 30))
    for specs in (TOTALS[:1], TOTALS[3:8], TOTALS[::-1][:5]):
        assert _same(TOT.totals_all(conn, specs), TOT.totals_all(conn, specs, strategy="union"))


def test_a_stored_run_is_shuffled_once(spark, make_log, tmp_path, monkeypatch):
    log, hints = _log(make_log), []
    frame = type(log)
    plain = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *args: (hints.append(name), plain(self, name, *args))[1])
    metrics = {}
    path = jobs.job_totals(log, str(tmp_path), run_ts="2018-12-04 00:00:00", metrics=metrics)
    assert "rebalance" not in hints
    want = TOT.totals_all(scans.scan_conn(log), strategy="union")
    assert _same(read_results(spark, path).select(*want.columns), want) and metrics["rows"] == want.count()


def test_partitions_do_not_depend_on_the_session(spark):
    from flowlens.session import configure

    configure(spark)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 400 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert RUNTIME_CONF["spark.sql.files.maxPartitionBytes"] == "16m"


def test_merged_runs_are_aggregated_set_by_set(spark, make_log, monkeypatch):
    conn, plans = scans.scan_conn(_log(make_log)), []
    plain = TotalsState.merge
    monkeypatch.setattr(registry, "conn", lambda spark, sf_dir: conn)
    monkeypatch.setattr(TotalsState, "merge", lambda self, totals, run: (plans.append(totals._jdf.queryExecution().executedPlan().toString()), plain(self, totals, run))[1])
    found = registry.queries()["totals_merged"](spark, "none")
    assert len(plans) == 4 and not any("Expand" in p for p in plans)  # up to three sets in a task before
    assert _same(found, registry.rounded(TOT.totals_all(conn)))


def test_joined_partitions_are_no_larger_than_what_a_task_reads(spark):
    from flowlens.session import configure

    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == RUNTIME_CONF["spark.sql.files.maxPartitionBytes"]
