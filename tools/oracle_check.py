"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Compares row count, column names (sorted) and an order-insensitive hash of
the values, the way the round driver does.  Usage:

    python tools/oracle_check.py [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = [columns[i].lower() for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), names, h


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "array<string>": "VARCHAR[]",
    "array<double>": "DOUBLE[]", "date": "DATE",
}


def spark_types(df) -> dict[str, str]:
    return {f.name.lower(): SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}


def duck_types(con, sql) -> dict[str, str]:
    rel = con.sql(sql)
    return {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return digest(df.columns, rows)


def duck_digest(con, sql):
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")  # as a view: some statements run but cannot be stored
    cur = con.execute("SELECT * FROM checked")
    cols = [d[0] for d in cur.description]
    rows = cur.fetchall()
    return digest(cols, rows)


def check(spark, sf_dir, names=None, verbose=True):
    from flowlens.plans.registry import registry

    reg = registry()
    con = duckdb_connection(sf_dir)
    results = {}
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.run(spark, sf_dir)
            s = spark_digest(sdf)
        except Exception as e:  # report, keep going
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:40s} SPARK-ERROR {results[name][1]}", flush=True)
            continue
        if q.sql is None:
            results[name] = ("rows-only", s[0])
            if verbose:
                print(f"{name:40s} rows-only rows={s[0]} {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            d = duck_digest(con, q.sql)
        except Exception as e:
            results[name] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:40s} SQL-ERROR {results[name][1]}", flush=True)
            continue
        ok = s == d
        detail = "" if ok else f" spark={s[0]} {s[1]} duck={d[0]} {d[1]}"
        st, dtypes = spark_types(sdf), duck_types(con, q.sql)
        type_diff = {k: (st.get(k), dtypes.get(k)) for k in set(st) | set(dtypes) if st.get(k) != dtypes.get(k)}
        if type_diff:
            detail += f" TYPES {type_diff}"
        results[name] = ("ok" if ok else "MISMATCH", s[0])
        if verbose:
            print(f"{name:40s} {'ok' if ok else 'MISMATCH'} rows={s[0]} {time.time()-t0:.1f}s{detail}", flush=True)
    return results


def main():
    p = argparse.ArgumentParser()
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    from flowlens.session import local_session

    spark = local_session(8)
    res = check(spark, a.sf_dir, set(a.names) or None)
    bad = [n for n, r in res.items() if r[0] not in ("ok", "rows-only")]
    print(f"{len(res)} checked, {len(bad)} bad: {bad}")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
