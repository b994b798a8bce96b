"""A2 per-minute DDoS aggregate and A3 per-minute port-scan aggregate.

Both are one filter + one hash aggregate with map-side combine, so a single
attacker holding a large share of the rows is reduced inside each map task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.time import bucket
from flowlens.schemas import COUNT, DDOS_KEYS, MEASURES, PROTO, RESP_P, SCAN_KEYS, SERVICE, TS, check_columns

# Output order of the measures in the per-minute tables (fixed values).
MINUTE_MEASURES = (
    "DURATION", "ORIG_PKTS", "ORIG_IP_BYTES", "ORIG_BYTES", "RESP_PKTS", "RESP_IP_BYTES", "RESP_BYTES",
)


def per_minute(conn: DataFrame, keys, unit: str = "minute", extra_aggs=()) -> DataFrame:
    check_columns(conn, (TS, *keys, *MEASURES), "connection records")
    minute = bucket(conn, TS, unit).alias(TS)
    return (
        conn.select(*keys, minute, *MEASURES, *([RESP_P] if extra_aggs and RESP_P not in keys else []))
        .groupBy(*keys, TS)
        .agg(*[F.sum(m).alias(m) for m in MINUTE_MEASURES], F.count(F.lit(1)).alias(COUNT), *extra_aggs)
    )


def ddos_minutes(conn: DataFrame, service: str) -> DataFrame:
    """A2: per source, target, target port, protocol and minute for one SERVICE."""
    return per_minute(conn.where(F.col(SERVICE) == F.lit(service)), DDOS_KEYS)


def scan_minutes(conn: DataFrame, proto: str, distinct_resp_ports: bool = False) -> DataFrame:
    """A3: per source, source port, target, protocol and minute for one PROTO.

    COUNT counts connections (rows).  ``distinct_resp_ports`` adds
    DISTINCT_RESP_P, the number of different target ports, as an extra.
    """
    extra = (F.countDistinct(RESP_P).alias("DISTINCT_RESP_P"),) if distinct_resp_ports else ()
    return per_minute(conn.where(F.col(PROTO) == F.lit(proto)), SCAN_KEYS, extra_aggs=extra)


def minutes_for(conn: DataFrame, kind: str, values) -> DataFrame:
    """A2 or A3 for several services / protocols in one aggregate.

    SERVICE (DDoS) and PROTO (scan) are grouping keys of their tables, so
    one scan and one shuffle serve every value; slice the result with a
    filter on that column.
    """
    values = list(values)
    if kind == "ddos":
        return per_minute(conn.where(F.col(SERVICE).isin(values)), DDOS_KEYS)
    if kind == "scan":
        return per_minute(conn.where(F.col(PROTO).isin(values)), SCAN_KEYS)
    raise ValueError(f"kind must be 'ddos' or 'scan', not {kind!r}")


LG_SKETCH = 12  # 2**12 registers: a standard error of about 1.6 per cent beyond the sizes that a sketch holds exactly
PORT_KEYS = ("ID_ORIG_H", "ID_RESP_H", PROTO)


def port_sketches(conn: DataFrame, proto: str, keys=PORT_KEYS, lg: int = LG_SKETCH) -> DataFrame:
    """Per ``keys`` and minute: COUNT, and a mergeable sketch of the target ports (RESP_P_SKETCH), of bounded size for any number of ports.

    Exact distinct counts do not add up over minutes; sketches do (``union_sketches``), so minutes can be stored and rolled up.
    """
    check_columns(conn, (TS, *keys, RESP_P), "connection records")
    rows = conn.where(F.col(PROTO) == F.lit(proto)).select(*keys, bucket(conn, TS, "minute").alias(TS), RESP_P)
    return rows.groupBy(*keys, TS).agg(F.count(F.lit(1)).alias(COUNT), F.hll_sketch_agg(RESP_P, F.lit(lg)).alias("RESP_P_SKETCH"))


def union_sketches(sketches: DataFrame, unit: str = "hour", keys=PORT_KEYS) -> DataFrame:
    """Minutes of ``port_sketches`` rolled up to ``unit``; ``distinct_ports`` reads the number of ports."""
    rows = sketches.withColumn(TS, bucket(sketches, TS, unit))
    return rows.groupBy(*keys, TS).agg(F.sum(COUNT).alias(COUNT), F.hll_union_agg("RESP_P_SKETCH").alias("RESP_P_SKETCH"))


def distinct_ports(sketches: DataFrame) -> DataFrame:
    """``sketches`` with DISTINCT_RESP_P, the (estimated) number of target ports, in place of the sketch."""
    return sketches.withColumn("DISTINCT_RESP_P", F.hll_sketch_estimate("RESP_P_SKETCH")).drop("RESP_P_SKETCH")


# Export order of the per-minute tables.
def minutes_order():
    return [F.col("ID_ORIG_H"), F.col(TS), F.col(COUNT)]
