"""The LOG and IP tables as views over the driver's test tables.

The test data has no network logs, so LOG is derived from ``events`` (one
connection every 3 seconds, every 20th minute a burst from one attacker to
one target) and the IP tables from ``supplier``/``nation``/``region``.
The DataFrame code here and the SQL in ``oracle_cte`` describe the same
rows; the oracle tests check that they agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.schemas import IP_INFO_TYPES, LOG_COLUMNS, LOG_TYPES

# Fixed fixture constants.
BASE_TS = "2018-12-03 00:00:00"
SECONDS_PER_EVENT = 3
CODE_DELAY_SECONDS = 5
BURST_PERIOD, BURST_ROWS = 400, 20
ATTACKER, TARGET = "10.0.0.66", "203.0.0.10"
CACHE_BASE_TS = "2018-12-02 12:00:00"
DEFAULT_SINCE = "2018-12-03 00:20:05.000"  # TS_CODE of event 400: rows before it and one exactly on it are left out


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_BURST = f"event_id % {BURST_PERIOD} < {BURST_ROWS}"
_TS = f"timestampadd(SECOND, event_id * {SECONDS_PER_EVENT}, TIMESTAMP_NTZ '{BASE_TS}')"

# One projection per branch, as Spark SQL expressions (parsed once on the JVM).
CONN_BASE_EXPRS = (
    "event_id", "user_id",
    "concat('C', CAST(event_id AS STRING)) AS UID",
    f"{_TS} AS TS",
    f"{_TS} + INTERVAL {CODE_DELAY_SECONDS} SECOND AS TS_CODE",
    f"CASE WHEN {_BURST} THEN '{ATTACKER}' ELSE concat('10.1.', CAST(floor(user_id / 256) AS STRING), '.', "
    "CAST(user_id % 256 AS STRING)) END AS ID_ORIG_H",
    f"CASE WHEN {_BURST} THEN CAST(40000 AS BIGINT) ELSE 1024 + (event_id * 7) % 5000 END AS ID_ORIG_P",
    f"CASE WHEN {_BURST} THEN '{TARGET}' ELSE concat('203.0.0.', CAST((user_id * 31) % 150 AS STRING)) END AS ID_RESP_H",
    f"CASE WHEN {_BURST} THEN CAST(80 AS BIGINT) WHEN event_type = 'signup' THEN 53 WHEN event_type = 'click' THEN 80 "
    "WHEN event_type = 'view' THEN 443 WHEN event_type = 'purchase' THEN 22 ELSE 1 + event_id % 1000 END AS ID_RESP_P",
    f"CASE WHEN NOT ({_BURST}) AND event_type = 'signup' THEN 'udp' ELSE 'tcp' END AS PROTO",
    f"CASE WHEN {_BURST} THEN 'http' WHEN event_type = 'signup' THEN 'dns' WHEN event_type = 'click' THEN 'http' "
    "WHEN event_type = 'view' THEN 'ssl' WHEN event_type = 'purchase' THEN 'ssh' END AS SERVICE",
    "CASE WHEN event_id % 11 <> 0 THEN value END AS DURATION",
    "CASE WHEN event_id % 11 <> 0 THEN event_id % 1500 END AS ORIG_BYTES",
    "CASE WHEN event_id % 11 <> 0 THEN (event_id * 13) % 9000 END AS RESP_BYTES",
    "1 + event_id % 5 AS ORIG_PKTS", "40 + event_id % 60 AS ORIG_IP_BYTES",
    "1 + event_id % 4 AS RESP_PKTS", "60 + event_id % 90 AS RESP_IP_BYTES",
)

_CONN_BASE_COLUMNS = ("TS_CODE", "TS", "UID", "ID_ORIG_H", "ID_ORIG_P", "ID_RESP_H", "ID_RESP_P", "PROTO")
_CONN_ONLY = ("SERVICE", "DURATION", "ORIG_BYTES", "RESP_BYTES", "ORIG_PKTS", "ORIG_IP_BYTES", "RESP_PKTS",
              "RESP_IP_BYTES")

CONN_VALUES = {
    "TIPO": "'CONN'", "CONN_STATE": "'SF'", "LOCAL_ORIG": "TRUE", "LOCAL_RESP": "FALSE",
    "MISSED_BYTES": "0", "HISTORY": "'ShAD'", **{c: c for c in _CONN_BASE_COLUMNS + _CONN_ONLY},
}
# The DNS columns that are constant in the fixture are literals.
DNS_VALUES = {
    "TIPO": "'DNS'", **{c: c for c in _CONN_BASE_COLUMNS},
    "TRANS_ID": "event_id % 65536",
    "QUERY": "concat(CASE WHEN user_id % 3 = 0 THEN 'mail' ELSE 'www' END, '.site', CAST(user_id % 20 AS STRING), "
             "'.example')",
    "QCLASS": "1", "QCLASS_NAME": "'C_INTERNET'", "QTYPE": "qtype",
    "QTYPE_NAME": "CASE WHEN qtype = 1 THEN 'A' ELSE 'AAAA' END", "RCODE": "0", "RCODE_NAME": "'NOERROR'",
    "AA": "FALSE", "TC": "FALSE", "RD": "TRUE", "RA": "TRUE", "Z": "0", "REJECTED": "FALSE",
}
HTTP_VALUES = {
    "TIPO": "'HTTP'", **{c: c for c in _CONN_BASE_COLUMNS},
    "TRANS_DEPTH": "1", "VERSION": "'1.1'", "REQUEST_BODY_LEN": "event_id % 700",
    "RESPONSE_BODY_LEN": "(event_id * 3) % 5000",
    "STATUS_CODE": "CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END",
    "STATUS_MSG": "CASE WHEN event_id % 10 = 0 THEN 'Not Found' ELSE 'OK' END",
}


def conn_base(events: DataFrame) -> DataFrame:
    return events.selectExpr(*CONN_BASE_EXPRS)


def _complete(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Project onto the full LOG layout; absent columns are typed nulls."""
    exprs = [f"CAST({values.get(c, 'NULL')} AS {LOG_TYPES[c].simpleString()}) AS {c}" for c in LOG_COLUMNS]
    return df.selectExpr(*exprs)


def log_table(events: DataFrame) -> DataFrame:
    """LOG: CONN rows, two DNS rows (qtype A and AAAA) per DNS lookup, HTTP rows."""
    base = conn_base(events)
    conn = _complete(base, CONN_VALUES)
    dns_src = base.where("SERVICE = 'dns'").selectExpr("*", "explode(array(1, 28)) AS qtype")
    dns = _complete(dns_src, DNS_VALUES)
    http = _complete(base.where("SERVICE = 'http'"), HTTP_VALUES)
    return conn.unionByName(dns).unionByName(http)


IP_ROWS_EXPRS = (
    "concat('203.0.0.', CAST(s_suppkey AS STRING)) AS IP",
    "concat('host', CAST(s_suppkey AS STRING)) AS HOSTNAME",
    "concat('city', CAST(s_suppkey % 7 AS STRING)) AS CITY",
    "r_name AS REGION", "n_name AS COUNTRY", "s_name AS ORG",
    "CAST(s_suppkey % 180 - 90 AS DOUBLE) AS LATITUDE",
    "CAST(s_suppkey % 360 - 180 AS DOUBLE) AS LONGITUDE",
    f"timestampadd(MINUTE, s_suppkey * 10, TIMESTAMP_NTZ '{CACHE_BASE_TS}') AS TS_CODE",
    "s_suppkey AS _key",
)


def _ip_rows(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    s = supplier
    return (
        s.join(nation, s.s_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .selectExpr(*IP_ROWS_EXPRS)
    )


def ip_info_table(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """IP_INFO cache: every third host is missing, every fourth has an older lookup too."""
    rows = _ip_rows(supplier, nation, region).where("_key % 3 <> 0")
    older = rows.where("_key % 4 = 0").selectExpr(
        *[{"HOSTNAME": "concat('old-', HOSTNAME) AS HOSTNAME", "TS_CODE": "TS_CODE - INTERVAL 1 DAY AS TS_CODE"}.get(c, c)
          for c in IP_INFO_TYPES])
    return rows.select(*IP_INFO_TYPES).unionByName(older)


def ip_directory_table(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """The lookup source that stands in for the external IP service."""
    return _ip_rows(supplier, nation, region).select(*[c for c in IP_INFO_TYPES if c != "TS_CODE"])


class Tables:
    """The fixture tables of one folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def _dims(self):
        r = lambda n, *cols: _read(self.spark, self.sf_dir, n).select(*cols)
        return (r("supplier", "s_suppkey", "s_name", "s_nationkey"),
                r("nation", "n_nationkey", "n_name", "n_regionkey"),
                r("region", "r_regionkey", "r_name"))

    @property
    def log(self) -> DataFrame:
        return self._get("log", lambda: log_table(self._events()))

    def _events(self) -> DataFrame:
        return _read(self.spark, self.sf_dir, "events").select("event_id", "user_id", "event_type", "value")

    @property
    def ip_info(self) -> DataFrame:
        return self._get("ip_info", lambda: ip_info_table(*self._dims()))

    @property
    def ip_directory(self) -> DataFrame:
        return self._get("ip_directory", lambda: ip_directory_table(*self._dims()))

    def register_views(self) -> None:
        self.log.createOrReplaceTempView("LOG")
        self.ip_info.createOrReplaceTempView("IP_INFO")
        self.ip_directory.createOrReplaceTempView("IP_DIRECTORY")


def load(spark: SparkSession, sf_dir: str) -> Tables:
    """The fixture tables of ``sf_dir`` (lazy; each built on first use)."""
    return Tables(spark, sf_dir)
