"""DuckDB SQL that states each registered query independently of Spark.

Only the raw driver tables are registered in DuckDB, so the fixture views
(LOG, IP_INFO, IP_DIRECTORY) are inlined as CTEs.  Text is generated from
the same data (``schemas.TOTALS``) as the Spark side.
"""

from __future__ import annotations

from flowlens.schemas import DIMENSIONS, MEASURES, TOTALS, TotalSpec
from flowlens.sources.fixtures import (
    ATTACKER,
    BASE_TS,
    BURST_PERIOD,
    BURST_ROWS,
    CACHE_BASE_TS,
    CODE_DELAY_SECONDS,
    DEFAULT_SINCE,
    SECONDS_PER_EVENT,
    TARGET,
)

DIM_SQL_TYPE = {
    "ID_ORIG_H": "VARCHAR", "ID_ORIG_P": "BIGINT", "ID_RESP_H": "VARCHAR",
    "ID_RESP_P": "BIGINT", "PROTO": "VARCHAR", "SERVICE": "VARCHAR",
}

_TS = f"(TIMESTAMP '{BASE_TS}' + event_id * {SECONDS_PER_EVENT} * INTERVAL 1 SECOND)"
_BURST = f"event_id % {BURST_PERIOD} < {BURST_ROWS}"

CONN_BASE = f"""conn_base AS (
  SELECT event_id, user_id, 'C' || CAST(event_id AS VARCHAR) AS UID,
    {_TS} AS TS, {_TS} + INTERVAL {CODE_DELAY_SECONDS} SECOND AS TS_CODE,
    CASE WHEN {_BURST} THEN '{ATTACKER}'
         ELSE '10.1.' || CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) END AS ID_ORIG_H,
    CAST(CASE WHEN {_BURST} THEN 40000 ELSE 1024 + (event_id * 7) % 5000 END AS BIGINT) AS ID_ORIG_P,
    CASE WHEN {_BURST} THEN '{TARGET}' ELSE '203.0.0.' || CAST((user_id * 31) % 150 AS VARCHAR) END AS ID_RESP_H,
    CAST(CASE WHEN {_BURST} THEN 80 WHEN event_type = 'signup' THEN 53 WHEN event_type = 'click' THEN 80
         WHEN event_type = 'view' THEN 443 WHEN event_type = 'purchase' THEN 22 ELSE 1 + event_id % 1000 END AS BIGINT) AS ID_RESP_P,
    CASE WHEN NOT ({_BURST}) AND event_type = 'signup' THEN 'udp' ELSE 'tcp' END AS PROTO,
    CASE WHEN {_BURST} THEN 'http' WHEN event_type = 'signup' THEN 'dns' WHEN event_type = 'click' THEN 'http'
         WHEN event_type = 'view' THEN 'ssl' WHEN event_type = 'purchase' THEN 'ssh' END AS SERVICE,
    CASE WHEN event_id % 11 <> 0 THEN value END AS DURATION,
    CAST(CASE WHEN event_id % 11 <> 0 THEN event_id % 1500 END AS BIGINT) AS ORIG_BYTES,
    CAST(CASE WHEN event_id % 11 <> 0 THEN (event_id * 13) % 9000 END AS BIGINT) AS RESP_BYTES,
    CAST(1 + event_id % 5 AS BIGINT) AS ORIG_PKTS, CAST(40 + event_id % 60 AS BIGINT) AS ORIG_IP_BYTES,
    CAST(1 + event_id % 4 AS BIGINT) AS RESP_PKTS, CAST(60 + event_id % 90 AS BIGINT) AS RESP_IP_BYTES
  FROM events)"""

LOG_CTE = """LOG AS (
  SELECT 'CONN' AS TIPO, TS_CODE, TS, UID, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, PROTO, SERVICE,
    DURATION, ORIG_BYTES, RESP_BYTES, 'SF' AS CONN_STATE, TRUE AS LOCAL_ORIG, FALSE AS LOCAL_RESP,
    CAST(0 AS BIGINT) AS MISSED_BYTES, 'ShAD' AS HISTORY, ORIG_PKTS, ORIG_IP_BYTES, RESP_PKTS, RESP_IP_BYTES
  FROM conn_base
  UNION ALL BY NAME
  SELECT 'DNS' AS TIPO, TS_CODE, TS, UID, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, PROTO,
    CAST(event_id % 65536 AS BIGINT) AS TRANS_ID,
    CASE WHEN user_id % 3 = 0 THEN 'mail' ELSE 'www' END || '.site' || CAST(user_id % 20 AS VARCHAR) || '.example' AS QUERY,
    CAST(1 AS BIGINT) AS QCLASS, 'C_INTERNET' AS QCLASS_NAME, CAST(t.qtype AS BIGINT) AS QTYPE,
    CASE WHEN t.qtype = 1 THEN 'A' ELSE 'AAAA' END AS QTYPE_NAME, CAST(0 AS BIGINT) AS RCODE,
    'NOERROR' AS RCODE_NAME, FALSE AS AA, FALSE AS TC, TRUE AS RD, TRUE AS RA, CAST(0 AS BIGINT) AS Z,
    FALSE AS REJECTED
  FROM conn_base CROSS JOIN (SELECT 1 AS qtype UNION ALL SELECT 28) t WHERE SERVICE = 'dns'
  UNION ALL BY NAME
  SELECT 'HTTP' AS TIPO, TS_CODE, TS, UID, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, PROTO,
    CAST(1 AS BIGINT) AS TRANS_DEPTH, '1.1' AS VERSION, CAST(event_id % 700 AS BIGINT) AS REQUEST_BODY_LEN,
    CAST((event_id * 3) % 5000 AS BIGINT) AS RESPONSE_BODY_LEN,
    CAST(CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS BIGINT) AS STATUS_CODE,
    CASE WHEN event_id % 10 = 0 THEN 'Not Found' ELSE 'OK' END AS STATUS_MSG
  FROM conn_base WHERE SERVICE = 'http')"""

IP_ROWS_CTE = f"""ip_rows AS (
  SELECT s_suppkey AS k, '203.0.0.' || CAST(s_suppkey AS VARCHAR) AS IP, 'host' || CAST(s_suppkey AS VARCHAR) AS HOSTNAME,
    'city' || CAST(s_suppkey % 7 AS VARCHAR) AS CITY, r_name AS REGION, n_name AS COUNTRY, s_name AS ORG,
    CAST(s_suppkey % 180 - 90 AS DOUBLE) AS LATITUDE, CAST(s_suppkey % 360 - 180 AS DOUBLE) AS LONGITUDE,
    TIMESTAMP '{CACHE_BASE_TS}' + s_suppkey * 10 * INTERVAL 1 MINUTE AS TS_CODE
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
IP_INFO AS (SELECT IP, HOSTNAME, CITY, REGION, COUNTRY, ORG, LATITUDE, LONGITUDE, TS_CODE FROM ip_rows WHERE k % 3 <> 0
  UNION ALL SELECT IP, 'old-' || HOSTNAME, CITY, REGION, COUNTRY, ORG, LATITUDE, LONGITUDE, TS_CODE - INTERVAL 1 DAY
  FROM ip_rows WHERE k % 3 <> 0 AND k % 4 = 0),
IP_DIRECTORY AS (SELECT IP, HOSTNAME, CITY, REGION, COUNTRY, ORG, LATITUDE, LONGITUDE FROM ip_rows)"""

SINCE_SQL = f"TIMESTAMP '{DEFAULT_SINCE}'"
CONN_CTE = f"conn AS (SELECT * FROM LOG WHERE TIPO = 'CONN' AND TS_CODE > {SINCE_SQL})"


def with_ctes(body: str, *extra: str, ip: bool = False) -> str:
    ctes = [CONN_BASE, LOG_CTE, CONN_CTE]
    if ip:
        ctes.append(IP_ROWS_CTE)
    ctes.extend(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def measures_sql(round_doubles: bool = True) -> str:
    parts = ['COUNT(*) AS "COUNT"']
    for m in MEASURES:
        if m == "DURATION":
            parts.append(f"ROUND(SUM({m}), 4) AS {m}" if round_doubles else f"SUM({m}) AS {m}")
        else:
            parts.append(f"CAST(SUM({m}) AS BIGINT) AS {m}")
    return ", ".join(parts)


def total_select(spec: TotalSpec, source: str = "conn", unit: str = "hour") -> str:
    dims = []
    for d in DIMENSIONS:
        dims.append(d if d in spec.dims else f"CAST(NULL AS {DIM_SQL_TYPE[d]}) AS {d}")
    group = ", ".join([f"date_trunc('{unit}', TS)", *spec.dims])
    return (
        f"SELECT date_trunc('{unit}', TS) AS TS, {', '.join(dims)}, {measures_sql()}, '{spec.tipo}' AS TIPO "
        f"FROM {source} GROUP BY {group}"
    )


def totals_sql(spec: TotalSpec) -> str:
    return with_ctes(total_select(spec))


def totals_all_sql() -> str:
    return with_ctes("\nUNION ALL\n".join(total_select(s) for s in TOTALS))


def resp_h_totals_cte() -> str:
    return "resp_h_totals AS (" + total_select(TOTALS[[t.tipo for t in TOTALS].index("RESP_H")]) + ")"


# ------------------------------------------------------------ web names
DNS_WWW_CTE = (
    "dns_www AS (SELECT UID, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, QUERY FROM LOG "
    f"WHERE TIPO = 'DNS' AND TS_CODE > {SINCE_SQL} AND QUERY LIKE '%www.%')"
)
CONN_BY_QUERY_CTE = (
    "conn_by_query AS (SELECT DISTINCT d.UID AS UID, c.ID_ORIG_H, c.ID_ORIG_P, c.ID_RESP_H, c.ID_RESP_P, "
    "c.PROTO, c.SERVICE, c.DURATION, c.ORIG_BYTES, c.RESP_BYTES, d.QUERY AS QUERY "
    "FROM dns_www d JOIN conn c ON d.UID = c.UID)"
)


def dns_www_sql() -> str:
    return with_ctes("SELECT * FROM dns_www", DNS_WWW_CTE)


def conn_by_query_sql() -> str:
    return with_ctes(
        "SELECT UID, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, PROTO, SERVICE, ROUND(DURATION, 4) AS DURATION, "
        "ORIG_BYTES, RESP_BYTES, QUERY FROM conn_by_query",
        DNS_WWW_CTE, CONN_BY_QUERY_CTE,
    )


def www_totals_sql() -> str:
    return with_ctes(
        "SELECT QUERY, ROUND(SUM(DURATION), 4) AS DURATION, CAST(SUM(ORIG_BYTES) AS BIGINT) AS ORIG_BYTES, "
        "CAST(SUM(RESP_BYTES) AS BIGINT) AS RESP_BYTES FROM conn_by_query GROUP BY QUERY",
        DNS_WWW_CTE, CONN_BY_QUERY_CTE,
    )


def top_consumers_sql(n: int = 100) -> str:
    from flowlens.schemas import CONN_COLUMNS

    cols = ", ".join("ROUND(DURATION, 4) AS DURATION" if c == "DURATION" else c for c in CONN_COLUMNS)
    return with_ctes(f"SELECT {cols} FROM conn ORDER BY ORIG_BYTES DESC NULLS LAST, UID ASC LIMIT {n}")


# ------------------------------------------------------- per-minute tables
MINUTE_MEASURES_SQL = (
    "ROUND(SUM(DURATION), 4) AS DURATION, CAST(SUM(ORIG_PKTS) AS BIGINT) AS ORIG_PKTS, "
    "CAST(SUM(ORIG_IP_BYTES) AS BIGINT) AS ORIG_IP_BYTES, CAST(SUM(ORIG_BYTES) AS BIGINT) AS ORIG_BYTES, "
    "CAST(SUM(RESP_PKTS) AS BIGINT) AS RESP_PKTS, CAST(SUM(RESP_IP_BYTES) AS BIGINT) AS RESP_IP_BYTES, "
    "CAST(SUM(RESP_BYTES) AS BIGINT) AS RESP_BYTES, COUNT(*) AS \"COUNT\""
)


def minutes_select(kind: str, value: str, round_doubles: bool = True) -> str:
    if kind == "ddos":
        keys, where = "ID_ORIG_H, ID_RESP_H, ID_RESP_P, PROTO, SERVICE", f"SERVICE = '{value}'"
    else:
        keys, where = "ID_ORIG_H, ID_ORIG_P, ID_RESP_H, PROTO", f"PROTO = '{value}'"
    measures = MINUTE_MEASURES_SQL if round_doubles else MINUTE_MEASURES_SQL.replace(
        "ROUND(SUM(DURATION), 4)", "SUM(DURATION)")
    return (f"SELECT {keys}, date_trunc('minute', TS) AS TS, {measures} FROM conn WHERE {where} "
            f"GROUP BY {keys}, date_trunc('minute', TS)")


def minutes_sql(kind: str, value: str) -> str:
    return with_ctes(minutes_select(kind, value))


def two_means_sql(kind: str, value: str, feature: str = '"COUNT"') -> str:
    return with_ctes(_two_means_select(feature), f"m AS ({minutes_select(kind, value, round_doubles=False)})")


def kmeans_labels_sql(kind: str, value: str) -> str:
    """MLlib's high/normal labels, stated through the exact two-means split."""
    keys = "ID_ORIG_H, ID_RESP_H, ID_RESP_P, PROTO, SERVICE" if kind == "ddos" else "ID_ORIG_H, ID_ORIG_P, ID_RESP_H, PROTO"
    body = (f'SELECT {keys}, TS, "COUNT", CASE WHEN best.K = 2 THEN "COUNT" > best.THRESHOLD ELSE FALSE END AS IS_HIGH '
            "FROM m CROSS JOIN best")
    return with_ctes(body, f"m AS ({minutes_select(kind, value, round_doubles=False)})",
                     f"best AS ({_two_means_select()})")


def _two_means_select(feature: str = '"COUNT"') -> str:
    return f"""SELECT N, K, THRESHOLD, LOW_N, HIGH_N, ROUND(LOW_CENTER, 4) AS LOW_CENTER,
  ROUND(HIGH_CENTER, 4) AS HIGH_CENTER, ROUND(COST, 4) AS COST FROM (
  SELECT CAST(tn AS BIGINT) AS N, CASE WHEN tn - nl > 0 THEN 2 ELSE 1 END AS K, x AS THRESHOLD,
    CAST(nl AS BIGINT) AS LOW_N, CAST(tn - nl AS BIGINT) AS HIGH_N,
    CAST(sl AS DOUBLE) / CAST(nl AS BIGINT) AS LOW_CENTER,
    CASE WHEN tn - nl > 0 THEN CAST(ts - sl AS DOUBLE) / CAST(tn - nl AS BIGINT) END AS HIGH_CENTER,
    GREATEST((CAST(ql AS DOUBLE) - CAST(sl AS DOUBLE) * CAST(sl AS DOUBLE) / CAST(nl AS BIGINT))
      + CASE WHEN tn - nl > 0 THEN CAST(tq - ql AS DOUBLE) - CAST(ts - sl AS DOUBLE) * CAST(ts - sl AS DOUBLE) / CAST(tn - nl AS BIGINT) ELSE 0.0 END,
      0.0) AS COST
  FROM (SELECT x, SUM(n) OVER w AS nl, SUM(n * x) OVER w AS sl, SUM(n * x * x) OVER w AS ql,
          SUM(n) OVER () AS tn, SUM(n * x) OVER () AS ts, SUM(n * x * x) OVER () AS tq
        FROM (SELECT {feature} AS x, CAST(COUNT(*) AS HUGEINT) AS n FROM m WHERE {feature} IS NOT NULL GROUP BY 1) v
        WINDOW w AS (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) c
) r ORDER BY K DESC, r.COST ASC, THRESHOLD ASC LIMIT 1"""


# ------------------------------------------------------------ enrichment
TODAY = "2018-12-03 00:00:00"
RUN_TS = "2018-12-03 12:00:00"
EARLIER_RUN = "2018-12-03 06:00:00"
TOP_HOSTS = 50  # below the hosts there are, so that limit and order matter
BATCH_LIMIT = 20
_ATTRS = "HOSTNAME, CITY, REGION, COUNTRY, ORG, LATITUDE, LONGITUDE"
ENRICH_CTES = (
    resp_h_totals_cte(),
    "hosts AS (SELECT DISTINCT ID_RESP_H FROM conn WHERE ID_RESP_H IS NOT NULL)",
    "cache AS (SELECT * FROM IP_INFO QUALIFY ROW_NUMBER() OVER (PARTITION BY IP ORDER BY TS_CODE DESC) = 1)",
    f"quota AS (SELECT COUNT(*) AS USED, GREATEST(1000 - COUNT(*), 0) AS FREE FROM IP_INFO "
    f"WHERE TS_CODE > TIMESTAMP '{TODAY}')",
    'top_hosts AS (SELECT ID_RESP_H, CAST(SUM("COUNT") AS BIGINT) AS "COUNT" FROM resp_h_totals '
    'GROUP BY ID_RESP_H ORDER BY "COUNT" DESC, ID_RESP_H ASC LIMIT %d)' % TOP_HOSTS,
    "misses AS (SELECT t.ID_RESP_H, CAST(SUM(t.\"COUNT\") AS BIGINT) AS \"COUNT\" FROM resp_h_totals t "
    "WHERE NOT EXISTS (SELECT 1 FROM IP_INFO i WHERE i.IP = t.ID_RESP_H) GROUP BY t.ID_RESP_H)",
    'batch AS (SELECT ID_RESP_H FROM (SELECT ID_RESP_H, ROW_NUMBER() OVER (ORDER BY "COUNT" DESC, ID_RESP_H) AS rn '
    f"FROM misses) x WHERE rn <= (SELECT LEAST({BATCH_LIMIT}, FREE) FROM quota))",
    "looked AS (SELECT b.ID_RESP_H AS IP, d.HOSTNAME, d.CITY, d.REGION, d.COUNTRY, d.ORG, d.LATITUDE, d.LONGITUDE, "
    f"d.IP IS NOT NULL AS LOOKUP_OK, TIMESTAMP '{RUN_TS}' AS TS_CODE FROM misses b LEFT JOIN IP_DIRECTORY d ON d.IP = b.ID_RESP_H)",
    f"info AS (SELECT IP, {_ATTRS} FROM cache UNION ALL SELECT IP, {_ATTRS} FROM looked WHERE LOOKUP_OK)",
)


def enrich_sql(body: str) -> str:
    return with_ctes(body, *ENRICH_CTES, ip=True)


_TOTALS_OUT = ("TS, PROTO, SERVICE, ID_ORIG_H, ID_ORIG_P, ID_RESP_H, ID_RESP_P, \"COUNT\", DURATION, ORIG_IP_BYTES, "
               "RESP_IP_BYTES, ORIG_PKTS, ORIG_BYTES, RESP_PKTS, RESP_BYTES, TIPO")
ENRICH_QUERIES = {
    "lookups_today": "SELECT USED, FREE FROM quota",
    "distinct_resp_hosts": "SELECT ID_RESP_H FROM hosts",
    "ip_cache_hits": f"SELECT c.IP, {_ATTRS} FROM cache c JOIN hosts h ON h.ID_RESP_H = c.IP",
    "ip_cache_misses": "SELECT h.ID_RESP_H FROM hosts h WHERE NOT EXISTS (SELECT 1 FROM IP_INFO i WHERE i.IP = h.ID_RESP_H)",
    "resp_host_counts": 'SELECT ID_RESP_H, CAST(SUM("COUNT") AS BIGINT) AS "COUNT" FROM resp_h_totals GROUP BY ID_RESP_H',
    "top_resp_hosts": "SELECT * FROM top_hosts",
    "lookup_batch": "SELECT ID_RESP_H FROM batch",
    "enrich_lookup": f"SELECT IP, {_ATTRS}, LOOKUP_OK, TS_CODE FROM looked",
    "ip_info_union": f"SELECT IP, {_ATTRS} FROM info",
    "enrich_resp_hosts": f"SELECT r.*, {', '.join('c.' + a for a in _ATTRS.split(', '))} "
                         "FROM resp_h_totals r LEFT JOIN cache c ON r.ID_RESP_H = c.IP",
    "export_resp_h_info": f"SELECT r.*, {', '.join('i.' + a for a in _ATTRS.split(', '))} "
                          "FROM resp_h_totals r LEFT JOIN info i ON r.ID_RESP_H = i.IP",
}


# ----------------------------------------------------------------- pivots
def _case_pivot(src: str, unit: str, dim: str, values: list, stamp: str = "") -> str:
    cols, rest = [], []
    for v in values:
        cond = f"{dim} IS NULL" if v is None else f"coalesce({dim} = '{v}', FALSE)"
        name = "null" if v is None else v
        cols.append(f'CAST(SUM(CASE WHEN {cond} THEN "COUNT" END) AS BIGINT) AS "{name}"')
        rest.append(f"NOT ({cond})")
    cols.append(f'CAST(SUM(CASE WHEN {" AND ".join(rest)} THEN "COUNT" END) AS BIGINT) AS OTHER')
    bucket = f"date_trunc('{unit}', TS)"
    return f"SELECT {stamp or bucket} AS TS, {', '.join(cols)} FROM {src} GROUP BY {bucket}"


def _long(src: str, unit: str, dim: str) -> str:
    return (f"SELECT date_trunc('{unit}', TS) AS TS, {dim}, CAST(SUM(\"COUNT\") AS BIGINT) AS \"COUNT\" "
            f"FROM {src} GROUP BY 1, {dim}")


def _totals_cte(tipo: str, name: str, where: str = "") -> str:
    spec = next(t for t in TOTALS if t.tipo == tipo)
    body = total_select(spec)
    if where:
        body = f"SELECT * FROM ({body}) x WHERE {where}"
    return f"{name} AS ({body})"


def pivot_totals_sql(tipo: str, dim: str, unit: str, values: list, where: str = "", label: str = "") -> str:
    """Wide form; ``label``: a strftime pattern for the bucket as text."""
    stamp = f"strftime(date_trunc('{unit}', TS), '{label}')" if label else ""
    return with_ctes(_case_pivot("src", unit, dim, values, stamp), _totals_cte(tipo, "src", where))


def long_totals_sql(tipo: str, dim: str, unit: str, where: str = "") -> str:
    return with_ctes(_long("src", unit, dim), _totals_cte(tipo, "src", where))


def long_minutes_sql(kind: str, values, dim: str, unit: str) -> str:
    src = "\nUNION ALL\n".join(minutes_select(kind, v) for v in values)
    return with_ctes(_long("src", unit, dim), f"src AS ({src})")


# ------------------------------------------------- clustering, stated through the exact split
def _kmeans_ctes(kind: str, value: str) -> tuple[str, str]:
    return f"m AS ({minutes_select(kind, value, round_doubles=False)})", f"best AS ({_two_means_select()})"


HIGH = 'CASE WHEN best.K = 2 THEN "COUNT" > best.THRESHOLD ELSE FALSE END'


def kmeans_select(kind: str, value: str) -> str:
    keys = "ID_ORIG_H, ID_RESP_H, ID_RESP_P, PROTO, SERVICE" if kind == "ddos" else "ID_ORIG_H, ID_ORIG_P, ID_RESP_H, PROTO"
    return (f'SELECT {keys}, TS, ROUND(DURATION, 4) AS DURATION, ORIG_PKTS, ORIG_IP_BYTES, ORIG_BYTES, RESP_PKTS, RESP_IP_BYTES, RESP_BYTES, "COUNT", '
            "CASE WHEN best.K = 2 THEN [best.LOW_CENTER, best.HIGH_CENTER] ELSE [best.LOW_CENTER] END AS CENTRES, "
            f"{HIGH} AS IS_HIGH FROM m CROSS JOIN best")


def kmeans_sql(kind: str, value: str) -> str:
    return with_ctes(kmeans_select(kind, value), *_kmeans_ctes(kind, value))


def kmeans_cost_sql(kind: str, value: str) -> str:
    return with_ctes("SELECT COST AS WSSSE FROM best", *_kmeans_ctes(kind, value))


def silhouette_sql(kind: str, value: str) -> str:
    return with_ctes("""SELECT ROUND(AVG(CASE WHEN n = 1 THEN 0.0 WHEN own < far THEN 1 - own / far WHEN own > far THEN far / own - 1 ELSE 0.0 END), 4) AS SILHOUETTE
  FROM (SELECT a.n, (a.n * x * x + a.q - 2 * x * a.s) / a.n * a.n / greatest(a.n - 1, 1) AS own, (b.n * x * x + b.q - 2 * x * b.s) / b.n AS far
        FROM p JOIN c a ON a.h = p.h JOIN c b ON b.h <> p.h) d""", *_kmeans_ctes(kind, value),
        f'p AS (SELECT CAST("COUNT" AS DOUBLE) AS x, {HIGH} AS h FROM m CROSS JOIN best)',
        "c AS (SELECT h, CAST(COUNT(*) AS DOUBLE) AS n, SUM(x) AS s, SUM(x * x) AS q FROM p GROUP BY h)")


def kmeans_multi_sql(value: str) -> str:
    """What no choice of start changes: the rows kept, and that each is at its nearest centre, the mean of its rows."""
    return with_ctes("SELECT ID_ORIG_H, ID_RESP_H, ID_RESP_P, PROTO, SERVICE, TS, ROUND(DURATION, 4) AS DURATION, ORIG_PKTS, ORIG_BYTES, "
                     "TRUE AS NEAREST FROM m WHERE DURATION IS NOT NULL AND ORIG_PKTS IS NOT NULL AND ORIG_BYTES IS NOT NULL",
                     f"m AS ({minutes_select('ddos', value, round_doubles=False)})")


def uncounted_sql() -> str:
    return with_ctes("SELECT * REPLACE (NULLIF(\"COUNT\", \"COUNT\") AS \"COUNT\") FROM resp_h_totals WHERE \"COUNT\" % 2 = 0",
                     resp_h_totals_cte())


def scan_ports_sql(value: str) -> str:
    keys = "ID_ORIG_H, ID_ORIG_P, ID_RESP_H, PROTO"
    return with_ctes(
        f"SELECT {keys}, date_trunc('minute', TS) AS TS, {MINUTE_MEASURES_SQL}, "
        f"COUNT(DISTINCT ID_RESP_P) AS DISTINCT_RESP_P FROM conn WHERE PROTO = '{value}' "
        f"GROUP BY {keys}, date_trunc('minute', TS)")


def stored_runs_sql() -> str:
    """Kinds of the two stored runs; rows of those of the newer one."""
    kinds = ", ".join(f"('{t.tipo}')" for t in TOTALS)
    earlier, later = (f"epoch_ms(TIMESTAMP '{r}')" for r in (EARLIER_RUN, RUN_TS))
    return (f"WITH counted AS (SELECT TIPO, CAST(COUNT(*) AS BIGINT) AS N FROM ({totals_all_sql()}) t GROUP BY TIPO), kinds(TIPO) AS (VALUES {kinds}) "
            f"SELECT TIPO, {later} AS RUN_ID, N FROM kinds LEFT JOIN counted USING (TIPO) UNION ALL SELECT TIPO, {earlier}, NULL FROM kinds")


def kmeans_later_sql(kind: str, value: str) -> str:
    """Minutes after SINCE at the nearest of the two centres of the rows up to SINCE."""
    keys = "ID_ORIG_H, ID_RESP_H, ID_RESP_P, PROTO, SERVICE" if kind == "ddos" else "ID_ORIG_H, ID_ORIG_P, ID_RESP_H, PROTO"
    fit = minutes_select(kind, value, round_doubles=False).replace("FROM conn", "FROM earlier")
    body = (f'SELECT {keys}, TS, "COUNT", CASE WHEN K = 2 THEN [LOW_CENTER, HIGH_CENTER] ELSE [LOW_CENTER] END AS CENTRES, '
            'CASE WHEN K = 2 THEN abs("COUNT" - HIGH_CENTER) < abs("COUNT" - LOW_CENTER) ELSE FALSE END AS IS_HIGH FROM later CROSS JOIN best')
    return with_ctes(body, f"earlier AS (SELECT * FROM LOG WHERE TIPO = 'CONN' AND TS_CODE <= {SINCE_SQL})", f"m AS ({fit})",
                     f"best AS ({_two_means_select()})", f"later AS ({minutes_select(kind, value, round_doubles=False)})")


def kmeans_multi_fixed_sql(value: str) -> str:
    return kmeans_multi_sql(value).replace("AS NEAREST", "AS FIXED")


def scan_hours_ports_sql(value: str) -> str:
    return with_ctes(f"SELECT ID_ORIG_H, ID_RESP_H, PROTO, date_trunc('hour', TS) AS TS, COUNT(*) AS \"COUNT\", COUNT(DISTINCT ID_RESP_P) AS DISTINCT_RESP_P "
                     f"FROM conn WHERE PROTO = '{value}' GROUP BY ALL")
