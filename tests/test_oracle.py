"""Every registered query equals its DuckDB oracle (row count, names, values)."""

import pytest

from flowlens.plans.registry import registry
from tools.oracle_check import duck_digest, duckdb_connection, spark_digest

REG = registry()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duckdb_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    q = REG[name]
    got = spark_digest(q.run(spark, sf_dir))
    assert q.sql is not None, "every query has SQL"
    assert got[0] > 0
    want = duck_digest(duck, q.sql)
    assert got[0] == want[0], f"row count {got[0]} != {want[0]}"
    assert got[1] == want[1], f"columns {got[1]} != {want[1]}"
    assert got[2] == want[2], "values differ"


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
