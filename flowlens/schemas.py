"""Column names, record layouts and the 21 totals, kept as data.

The connection-log model is one wide sparse table ``LOG`` whose rows are
connection, DNS or HTTP records told apart by ``TIPO``.  Result tables
(totals, per-minute k-means inputs, IP cache) are described here too, so
every operator and every oracle query is generated from the same lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- columns
TIPO = "TIPO"
TS = "TS"
TS_CODE = "TS_CODE"
UID = "UID"
ORIG_H = "ID_ORIG_H"
ORIG_P = "ID_ORIG_P"
RESP_H = "ID_RESP_H"
RESP_P = "ID_RESP_P"
PROTO = "PROTO"
SERVICE = "SERVICE"
QUERY = "QUERY"
COUNT = "COUNT"
IP = "IP"

# Record kinds of LOG (fixed values).
KIND_CONN = "CONN"
KIND_DNS = "DNS"
KIND_HTTP = "HTTP"

# Measures summed by every totals / per-minute aggregate, in output order
# (fixed values).
MEASURES = (
    "DURATION",
    "ORIG_IP_BYTES",
    "RESP_IP_BYTES",
    "ORIG_PKTS",
    "ORIG_BYTES",
    "RESP_PKTS",
    "RESP_BYTES",
)
DOUBLE_MEASURES = ("DURATION",)

# The six grouping dimensions of the totals and the weight of each in the
# grouping number (weight counted when the column is rolled up).
DIMENSIONS = (ORIG_H, ORIG_P, RESP_H, RESP_P, PROTO, SERVICE)
DIMENSION_WEIGHT = {ORIG_H: 32, ORIG_P: 16, RESP_H: 8, RESP_P: 4, PROTO: 2, SERVICE: 1}

# ------------------------------------------------------- record layouts
# Columns of each record view (fixed values).
CONN_COLUMNS = (
    "TIPO", "TS_CODE", "TS", "UID", "ID_ORIG_H", "ID_ORIG_P", "ID_RESP_H", "ID_RESP_P",
    "PROTO", "SERVICE", "DURATION", "ORIG_BYTES", "RESP_BYTES", "CONN_STATE",
    "LOCAL_ORIG", "LOCAL_RESP", "MISSED_BYTES", "HISTORY", "ORIG_PKTS", "ORIG_IP_BYTES",
    "RESP_PKTS", "RESP_IP_BYTES",
)
DNS_COLUMNS = (
    "TIPO", "TS_CODE", "TS", "UID", "ID_ORIG_H", "ID_ORIG_P", "ID_RESP_H", "ID_RESP_P",
    "PROTO", "TRANS_ID", "QUERY", "QCLASS", "QCLASS_NAME", "QTYPE", "QTYPE_NAME",
    "RCODE", "RCODE_NAME", "AA", "TC", "RD", "RA", "Z", "REJECTED",
)
HTTP_COLUMNS = (
    "TIPO", "TS_CODE", "TS", "UID", "ID_ORIG_H", "ID_ORIG_P", "ID_RESP_H", "ID_RESP_P",
    "PROTO", "TRANS_DEPTH", "VERSION", "REQUEST_BODY_LEN", "RESPONSE_BODY_LEN",
    "STATUS_CODE", "STATUS_MSG",
)
RECORD_COLUMNS = {KIND_CONN: CONN_COLUMNS, KIND_DNS: DNS_COLUMNS, KIND_HTTP: HTTP_COLUMNS}

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TS = T.TimestampNTZType()

LOG_TYPES = {
    "TIPO": _S, "TS_CODE": _TS, "TS": _TS, "UID": _S,
    "ID_ORIG_H": _S, "ID_ORIG_P": _L, "ID_RESP_H": _S, "ID_RESP_P": _L,
    "PROTO": _S, "SERVICE": _S, "DURATION": _D, "ORIG_BYTES": _L, "RESP_BYTES": _L,
    "CONN_STATE": _S, "LOCAL_ORIG": _B, "LOCAL_RESP": _B, "MISSED_BYTES": _L,
    "HISTORY": _S, "ORIG_PKTS": _L, "ORIG_IP_BYTES": _L, "RESP_PKTS": _L, "RESP_IP_BYTES": _L,
    "TRANS_ID": _L, "QUERY": _S, "QCLASS": _L, "QCLASS_NAME": _S, "QTYPE": _L,
    "QTYPE_NAME": _S, "RCODE": _L, "RCODE_NAME": _S, "AA": _B, "TC": _B, "RD": _B,
    "RA": _B, "Z": _L, "REJECTED": _B,
    "TRANS_DEPTH": _L, "VERSION": _S, "REQUEST_BODY_LEN": _L, "RESPONSE_BODY_LEN": _L,
    "STATUS_CODE": _L, "STATUS_MSG": _S,
}
LOG_COLUMNS = tuple(LOG_TYPES)
LOG_SCHEMA = T.StructType([T.StructField(c, t, True) for c, t in LOG_TYPES.items()])

IP_INFO_TYPES = {
    "IP": _S, "HOSTNAME": _S, "CITY": _S, "REGION": _S, "COUNTRY": _S, "ORG": _S,
    "LATITUDE": _D, "LONGITUDE": _D, "TS_CODE": _TS,
}
IP_INFO_SCHEMA = T.StructType([T.StructField(c, t, True) for c, t in IP_INFO_TYPES.items()])
IP_ATTRIBUTES = ("HOSTNAME", "CITY", "REGION", "COUNTRY", "ORG", "LATITUDE", "LONGITUDE")


def check_columns(df, required, what="input") -> None:
    """Fail early, with the missing names, when a frame lacks columns."""
    have = {f.name.upper() for f in df.schema.fields}
    missing = [c for c in required if c.upper() not in have]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


# ----------------------------------------------------------- the 21 totals
@dataclass(frozen=True)
class TotalSpec:
    """One hourly grouped total: its name, dimensions and export sort."""

    tipo: str
    dims: tuple[str, ...]
    export_sort: tuple[str, ...]

    @property
    def grouping_bits(self) -> int:
        """Sum of the weights of the dimensions rolled up in this set."""
        return sum(w for d, w in DIMENSION_WEIGHT.items() if d not in self.dims)

    @property
    def query_name(self) -> str:
        return "totals_" + self.tipo.lower()


# Name, dimensions and export sort keys of each total (fixed values).
TOTALS = (
    TotalSpec("PROTO", (PROTO,), (TS,)),
    TotalSpec("PROTO_SERVICE", (PROTO, SERVICE), (TS, PROTO, SERVICE)),
    TotalSpec("PROTO_ORIG_H", (PROTO, ORIG_H), (TS, PROTO, ORIG_H)),
    TotalSpec("PROTO_ORIG_H_P", (PROTO, ORIG_H, ORIG_P), (TS, PROTO, ORIG_H, ORIG_P)),
    TotalSpec("PROTO_RESP_H", (PROTO, RESP_H), (TS, PROTO, RESP_H)),
    TotalSpec("PROTO_RESP_H_P", (PROTO, RESP_H, RESP_P), (TS, PROTO, RESP_H, RESP_P)),
    TotalSpec("SERVICE", (SERVICE,), (TS,)),
    TotalSpec("PROTO_SERVICE_ORIG_H", (PROTO, SERVICE, ORIG_H), (TS, PROTO, SERVICE, ORIG_H)),
    TotalSpec("PROTO_SERVICE_ORIG_H_P", (PROTO, SERVICE, ORIG_H, ORIG_P),
              (TS, PROTO, SERVICE, ORIG_H, ORIG_P)),
    TotalSpec("PROTO_SERVICE_RESP_H", (PROTO, SERVICE, RESP_H), (TS, PROTO, SERVICE, RESP_H)),
    TotalSpec("PROTO_SERVICE_RESP_H_P", (PROTO, SERVICE, RESP_H, RESP_P),
              (TS, PROTO, SERVICE, RESP_H, RESP_P)),
    TotalSpec("ORIG_H", (ORIG_H,), (TS, ORIG_H)),
    TotalSpec("ORIG_P", (ORIG_P,), (TS, ORIG_P)),
    TotalSpec("ORIG_H_P", (ORIG_H, ORIG_P), (TS, ORIG_H, ORIG_P)),
    TotalSpec("ORIG_H_P_RESP_H", (ORIG_H, ORIG_P, RESP_H), (TS, ORIG_H, ORIG_P)),
    TotalSpec("RESP_H", (RESP_H,), (TS, RESP_H)),
    TotalSpec("RESP_P", (RESP_P,), (TS, RESP_P)),
    TotalSpec("RESP_H_P", (RESP_H, RESP_P), (TS, RESP_H, RESP_P)),
    TotalSpec("RESP_H_P_ORIG_H", (RESP_H, RESP_P, ORIG_H), (TS, RESP_H, RESP_P)),
    TotalSpec("ORIG_H_RESP_H", (ORIG_H, RESP_H), (TS, ORIG_H, RESP_H)),
    TotalSpec("ORIG_H_P_RESP_H_P", (ORIG_H, ORIG_P, RESP_H, RESP_P), (TS, ORIG_H, ORIG_P)),
)
TOTALS_BY_TIPO = {t.tipo: t for t in TOTALS}

TOTALS_COLUMNS = (TS, PROTO, SERVICE, ORIG_H, ORIG_P, RESP_H, RESP_P, COUNT, *MEASURES, TIPO)

# Per-minute aggregates feeding the clustering, and the values clustered by default (fixed values).
DDOS_KEYS = (ORIG_H, RESP_H, RESP_P, PROTO, SERVICE)
SCAN_KEYS = (ORIG_H, ORIG_P, RESP_H, PROTO)
DDOS_SERVICES = ("http", "ssh")
SCAN_PROTOS = ("tcp", "udp")
