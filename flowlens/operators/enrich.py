"""Enrich hosts with location and owner data through a cached lookup.

The IP_INFO cache may hold several rows per IP (one per lookup run); reads
keep the newest with ``max(struct(TS_CODE, ...))`` -- a hash aggregate with
map-side combine, so a hot IP does not pile up in one task.  Every join is
an equi-join on the IP string: Spark picks broadcast or sort-merge from
statistics and AQE re-plans at run time on measured sizes (no blind
broadcast hint, the cache grows with the data).

The external lookup (one HTTPS call per IP in the original design) is
re-aimed two ways:

* ``lookup``: a join against a supplied directory table (for example an
  exported geo-IP database), fully inside Spark;
* ``lookup_with``: ``mapInPandas`` around a user-supplied batch function,
  created once per partition and called once per Arrow batch; the daily
  quota and the limit of a run hold for this form only.

Failed lookups keep the IP with null attributes and ``LOOKUP_OK = false``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import bloom
from flowlens.functions.time import ntz_literal, parse_stamp, since_literal
from flowlens.session import reliable_checkpoint
from flowlens.sinks.quota import QuotaBook
from flowlens.schemas import COUNT, IP, IP_ATTRIBUTES, IP_INFO_TYPES, RESP_H, TS_CODE

DAILY_QUOTA = 1000  # calls of an external service a day (function form only)
LOOKUP_OK = "LOOKUP_OK"


def latest_ip_info(ip_info: DataFrame) -> DataFrame:
    """One row per IP: the newest successful lookup (ties broken by the attributes)."""
    if LOOKUP_OK in ip_info.columns:  # stored attempts; rows from before attempts were stored have no flag
        ip_info = ip_info.where(F.coalesce(F.col(LOOKUP_OK), F.lit(True)))
    cols = [c for c in (TS_CODE, *IP_ATTRIBUTES) if c in ip_info.columns]
    newest = F.max(F.struct(*cols)).alias("_newest")
    return ip_info.groupBy(IP).agg(newest).select(IP, *[F.col(f"_newest.{c}").alias(c) for c in cols])


def lookup_quota(ip_info: DataFrame, today, daily_quota: int = DAILY_QUOTA) -> DataFrame:
    """One row, USED = attempts (failed ones too) stored after ``today`` 00:00, FREE = quota left."""
    used = ip_info.where(F.col(TS_CODE) > since_literal(ip_info, TS_CODE, today))
    return used.agg(F.count(F.lit(1)).alias("USED")).select(
        "USED", F.greatest(F.lit(daily_quota) - F.col("USED"), F.lit(0)).alias("FREE")
    )


def distinct_hosts(data: DataFrame, field: str = RESP_H) -> DataFrame:
    """The distinct non-null values of ``field``."""
    return data.select(field).where(F.col(field).isNotNull()).distinct()


def cache_hits(ip_info: DataFrame, hosts: DataFrame, field: str = RESP_H) -> DataFrame:
    """Cached attributes of the given hosts (IP + attributes)."""
    keys = distinct_hosts(hosts, field).withColumnRenamed(field, IP)
    return latest_ip_info(ip_info.join(keys, IP, "left_semi")).select(IP, *IP_ATTRIBUTES)


def cache_misses(hosts: DataFrame, ip_info: DataFrame, field: str = RESP_H) -> DataFrame:
    """Hosts with no cached row (left anti join), distinct; a failed attempt counts as cached."""
    cached = ip_info.select(F.col(IP).alias(field)).where(F.col(field).isNotNull())
    return distinct_hosts(hosts, field).join(cached, field, "left_anti")


def possible_hits(ip_info: DataFrame, hosts: DataFrame, field: str = RESP_H) -> DataFrame:
    """The cached rows that may belong to the given hosts, for ``cache_hits`` and ``cache_misses`` to join exactly.

    A Bloom filter of the distinct hosts (stored, since they are counted first) goes to the scan of the cache, so
    of a cache much larger than the hosts of a run only a hundredth of the other rows is shuffled.
    """
    keys = reliable_checkpoint(distinct_hosts(hosts, field))
    blocks = bloom.blocks_for(keys.count())
    return bloom.possible(ip_info, IP, bloom.build(keys, field, blocks), blocks)


def lookup_batch(candidates: DataFrame, ip_info: DataFrame, free: int, field: str = RESP_H,
                 limit: int = DAILY_QUOTA, priority: Column | None = None) -> DataFrame:
    """E5: the misses to ask an external service for now, at most ``min(limit, free)``.

    Quota and limit protect that service; a join with a directory table has none.
    ``candidates`` may carry a COUNT column: busiest hosts go first, then
    by host, so the batch is repeatable.  Empty when any bound is 0.
    """
    n = min(int(limit), int(free))
    if n <= 0:
        return candidates.select(field).limit(0)
    cached = ip_info.select(F.col(IP).alias(field)).where(F.col(field).isNotNull())
    if priority is None and COUNT in candidates.columns:
        # One pass over the candidates: weight per host, minus cached hosts.
        weights = candidates.where(F.col(field).isNotNull()).groupBy(field).agg(F.sum(COUNT).alias("_w"))
        misses = weights.join(cached, field, "left_anti")
        return misses.orderBy(F.col("_w").desc_nulls_last(), F.col(field)).limit(n).select(field)
    misses = cache_misses(candidates, ip_info, field)
    order = [priority, F.col(field)] if priority is not None else [F.col(field)]
    return misses.orderBy(*order).limit(n)


def _stamp(df: DataFrame, run_ts) -> DataFrame:
    """TS_CODE = the run's stamp, fixed once on the driver (default: now, UTC)."""
    stamp = parse_stamp(run_ts) if run_ts is not None else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return df.withColumn(TS_CODE, ntz_literal(stamp))


def lookup(batch: DataFrame, directory: DataFrame, field: str = RESP_H, run_ts=None) -> DataFrame:
    """E6 + E7 (table form): attributes of each IP in ``batch`` from ``directory``.

    Output: IP, the attributes (null when unknown), LOOKUP_OK, TS_CODE.
    """
    ips = distinct_hosts(batch, field).withColumnRenamed(field, IP)
    one = F.max(F.struct(*IP_ATTRIBUTES)).alias("_a")  # the same row each time if an IP is listed twice
    d = directory.groupBy(IP).agg(one).select(IP, "_a.*")
    found = ips.join(d.withColumn("LOOKUP_OK", F.lit(True)), IP, "left")
    out = found.select(IP, *IP_ATTRIBUTES, F.coalesce(F.col("LOOKUP_OK"), F.lit(False)).alias("LOOKUP_OK"))
    return _stamp(out, run_ts)


LOOKUP_SCHEMA = (
    "IP string, HOSTNAME string, CITY string, REGION string, COUNTRY string, ORG string, "
    "LATITUDE double, LONGITUDE double, LOOKUP_OK boolean"
)


def lookup_with(batch: DataFrame, make_client: Callable[[], Callable[[pd.Series], pd.DataFrame]],
                field: str = RESP_H, run_ts=None) -> DataFrame:
    """E6 + E7 (function form): call a user-supplied batch lookup per partition.

    ``make_client()`` runs once per partition and returns ``fetch(ips)``,
    which gets a pandas Series of IPs and returns a DataFrame with any of
    the attribute columns, row-aligned with the input.  Latitude and
    longitude text is parsed with a null on failure.  If ``fetch`` raises,
    the batch is asked again IP by IP, and only those that raise again get LOOKUP_OK = false.
    """
    ips = distinct_hosts(batch, field).withColumnRenamed(field, IP)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = make_client()
        def answer(ips: pd.Series) -> pd.DataFrame:
            got = fetch(ips).reset_index(drop=True)
            out = pd.DataFrame({IP: ips.astype(object).values})
            for c in IP_ATTRIBUTES:
                col = got[c] if c in got.columns else pd.Series([None] * len(ips))
                if c in ("LATITUDE", "LONGITUDE"):
                    col = pd.to_numeric(col, errors="coerce")
                out[c] = col.values
            out[LOOKUP_OK] = True
            return out

        def one(ips: pd.Series) -> pd.DataFrame:
            try:
                return answer(ips)
            except Exception:  # a failed lookup keeps the IP, without attributes
                return pd.DataFrame({IP: ips.astype(object).values, **{c: [None] for c in IP_ATTRIBUTES}, LOOKUP_OK: [False]})

        for part in parts:
            try:
                yield answer(part[IP])
            except Exception:
                for i in range(len(part)):
                    yield one(part[IP].iloc[i:i + 1])

    looked = _stamp(ips.mapInPandas(run, LOOKUP_SCHEMA), run_ts)
    # The result feeds both the join and the cache write: keep it in the
    # checkpoint folder so the external service is called once per IP.
    return reliable_checkpoint(looked)


def ip_info_union(hits: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Cached attributes plus new lookups, matched by column name."""
    cols = [IP, *IP_ATTRIBUTES]
    return hits.select(*cols).unionByName(new_rows.where(F.col("LOOKUP_OK")).select(*cols))


def attach_ip_info(data: DataFrame, info: DataFrame, field: str = RESP_H, unique: bool = False) -> DataFrame:
    """Every row of ``data`` with the attributes of its host (left join).

    ``info`` is reduced to one row per IP first (skipped when the caller
    knows it already is, ``unique=True``), so no input row is duplicated;
    rows without a match keep null attributes.
    """
    if unique:
        per_ip = info.select(F.col(IP).alias("_ip"), *IP_ATTRIBUTES)
    else:
        per_ip = info.select(IP, *IP_ATTRIBUTES).groupBy(IP).agg(
            F.max(F.struct(*IP_ATTRIBUTES)).alias("_a")
        ).select(F.col(IP).alias("_ip"), *[F.col(f"_a.{c}").alias(c) for c in IP_ATTRIBUTES])
    return data.join(per_ip, data[field] == per_ip["_ip"], "left").drop("_ip")


def cache_rows(new_lookups: DataFrame) -> DataFrame:
    """The attempts to store in IP_INFO (cache layout and LOOKUP_OK; failed ones without attributes)."""
    return new_lookups.select(*[F.col(c).cast(t).alias(c) for c, t in IP_INFO_TYPES.items()], LOOKUP_OK)


def enrich(data: DataFrame, ip_info: DataFrame, field: str = RESP_H, directory: DataFrame | None = None,
           today=None, limit: int = DAILY_QUOTA, daily_quota: int = DAILY_QUOTA,
           candidates: DataFrame | None = None, run_ts=None, make_client=None, book: QuotaBook | None = None):
    """Attach IP attributes to ``data``, looking up what the cache lacks.

    Returns ``(enriched, new_cache_rows)``; ``new_cache_rows`` is None when
    no lookup ran.  With ``directory`` every host that the cache lacks is joined with
    it: no quota and no limit; the hosts found are the new rows.  With
    ``make_client`` an external service is asked, within ``limit`` and the day's quota,
    for ``candidates`` (default ``data``), busiest first; every attempt is a new row.  With ``book`` the
    run's calls are reserved before they are made, so that overlapping runs keep to the quota together.

    The cache is reduced to the hosts of ``data`` before its newest rows are
    picked, and hits and misses come from one left join with it.
    """
    hosts = distinct_hosts(data, field).withColumnRenamed(field, IP)
    if directory is not None and make_client is None:
        latest = latest_ip_info(ip_info.join(hosts, IP, "left_semi")).select(IP, F.struct(*IP_ATTRIBUTES).alias("_hit"))
        listed = directory.join(hosts, IP, "left_semi").groupBy(IP).agg(F.max(F.struct(*IP_ATTRIBUTES)).alias("_new"))
        known = reliable_checkpoint(hosts.join(latest, IP, "left").join(listed, IP, "left"))  # feeds the report and the cache
        info = known.select(IP, F.coalesce("_hit", "_new").alias("_a")).select(IP, "_a.*")
        fresh = known.where(F.col("_hit").isNull() & F.col("_new").isNotNull()).select(IP, "_new.*", F.lit(True).alias(LOOKUP_OK))
        return attach_ip_info(data, info, field, unique=True), cache_rows(_stamp(fresh, run_ts))
    latest = latest_ip_info(ip_info.join(hosts, IP, "left_semi"))
    if limit <= 0 or make_client is None:
        return attach_ip_info(data, latest, field, unique=True), None
    free = lookup_quota(ip_info, today, daily_quota).first()["FREE"]  # one number
    if book is not None:
        free = book.reserve(today, str(run_ts), min(limit, free))
    batch = lookup_batch(candidates if candidates is not None else data, ip_info, free, field, limit)
    new = lookup_with(batch, make_client, field, run_ts)
    # New lookups are cache misses only, so the union is still one row per IP.
    info = ip_info_union(latest, new)
    return attach_ip_info(data, info, field, unique=True), cache_rows(new)
