"""P4 web DNS names, J1 connections by DNS name, A4 totals per name, T3 top consumers.

J1 joins DNS lookups to the connections they belong to on ``UID``.  Only
UID and QUERY are taken from the DNS side (the id columns come from the
connection), so the DNS side is reduced to distinct (UID, QUERY) pairs
before the shuffle.  The join is a sort-merge join on UID (or a broadcast
when AQE measures a side below its threshold at run time); AQE's skew-join
handling splits a UID partition that is much larger than the others.  The
final DISTINCT includes UID, so the join's hash partitioning on UID already
satisfies it and it adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.schemas import CONN_COLUMNS, ORIG_H, ORIG_P, QUERY, RESP_H, RESP_P, UID, check_columns

WWW_PATTERN = "%www.%"

DNS_WWW_COLUMNS = (UID, ORIG_H, ORIG_P, RESP_H, RESP_P, QUERY)
CONN_BY_QUERY_COLUMNS = (UID, ORIG_H, ORIG_P, RESP_H, RESP_P, "PROTO", "SERVICE",
                         "DURATION", "ORIG_BYTES", "RESP_BYTES", QUERY)


def dns_www(dns: DataFrame, pattern: str = WWW_PATTERN) -> DataFrame:
    """DNS lookups whose QUERY matches ``pattern`` (LIKE, case-sensitive)."""
    check_columns(dns, DNS_WWW_COLUMNS, "DNS records")
    return dns.select(*DNS_WWW_COLUMNS).where(F.col(QUERY).like(pattern))


def conn_by_dns_query(conn: DataFrame, dns_names: DataFrame) -> DataFrame:
    """Each connection with the DNS name looked up for it (distinct rows)."""
    names = dns_names.select(UID, QUERY).distinct()
    c = conn.select(UID, ORIG_H, ORIG_P, RESP_H, RESP_P, "PROTO", "SERVICE",
                    "DURATION", "ORIG_BYTES", "RESP_BYTES")
    return names.join(c, UID, "inner").select(*CONN_BY_QUERY_COLUMNS).distinct()


def www_totals(conn_by_query: DataFrame) -> DataFrame:
    """A4: duration and bytes per DNS name."""
    return conn_by_query.groupBy(QUERY).agg(
        F.sum("DURATION").alias("DURATION"),
        F.sum("ORIG_BYTES").alias("ORIG_BYTES"),
        F.sum("RESP_BYTES").alias("RESP_BYTES"),
    )


def top_consumers(conn: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` connections with most ORIG_BYTES (ties by UID).

    Planned as TakeOrderedAndProject: each task keeps its own top n, so
    only n rows per task reach the final merge.
    """
    cols = [c for c in CONN_COLUMNS if c in conn.columns]
    return conn.select(*cols).orderBy(F.col("ORIG_BYTES").desc_nulls_last(), F.col(UID).asc()).limit(n)


# Export orders (sorts only happen when writing).
def conn_by_query_order():
    return [F.col("ORIG_BYTES").desc_nulls_last(), F.col(UID), F.col(QUERY)]


def www_totals_order():
    return [F.col("RESP_BYTES").desc_nulls_last(), F.col(QUERY)]


def dns_www_order():
    return [F.col(QUERY), F.col(UID)]
