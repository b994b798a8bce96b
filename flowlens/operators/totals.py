"""A1 hourly grouped totals, A5 connections per responder, T4 top responders.

``totals_all`` computes the 21 totals with GROUPING SETS instead of 21
queries, by default one for each family of nested sets.  Spark plans each grouping-sets aggregate as Expand -> partial
HashAggregate (map-side combine, so hot keys collapse before the shuffle)
-> one shuffle on the grouping keys -> final HashAggregate.  A task of either aggregate holds its
groups in memory, so those of few sets at a time.  The grouping number, not a null
test, names each row's set, so a null SERVICE in the data stays apart from
the rolled-up SERVICE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.grouping import grouping_number, tipo_of_grouping
from flowlens.functions.time import bucket
from flowlens.schemas import (
    COUNT,
    DIMENSION_WEIGHT,
    DIMENSIONS,
    MEASURES,
    ORIG_P,
    RESP_H,
    RESP_P,
    TIPO,
    TOTALS,
    TOTALS_BY_TIPO,
    TOTALS_COLUMNS,
    TS,
    TotalSpec,
    check_columns,
)


def measure_aggregates() -> list[Column]:
    """COUNT(*) and the seven sums, aliased to the column names."""
    return [F.count(F.lit(1)).alias(COUNT)] + [F.sum(m).alias(m) for m in MEASURES]


def _with_hour(conn: DataFrame, unit: str = "hour") -> DataFrame:
    check_columns(conn, (TS, *DIMENSIONS, *MEASURES), "connection records")
    return conn.select(bucket(conn, TS, unit).alias(TS), *DIMENSIONS, *MEASURES)


def _full_layout(df: DataFrame, conn: DataFrame) -> DataFrame:
    """Project onto the LOG_TOTAIS layout (absent dimensions are typed nulls)."""
    types = {f.name: f.dataType for f in conn.schema.fields}
    cols = []
    for c in TOTALS_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    return df.select(*cols)


def totals(conn: DataFrame, tipo: str | TotalSpec, unit: str = "hour") -> DataFrame:
    """One hourly total: COUNT and the sums per hour and the set's dimensions."""
    spec = tipo if isinstance(tipo, TotalSpec) else TOTALS_BY_TIPO[tipo]
    hourly = _with_hour(conn, unit)
    agg = hourly.groupBy(TS, *spec.dims).agg(*measure_aggregates()).withColumn(TIPO, F.lit(spec.tipo))
    return _full_layout(agg, conn)


def families(specs=TOTALS, most: int = 3) -> list[tuple[TotalSpec, ...]]:
    """The sets in families of at most ``most``: a set of many dimensions, then sets nested in it."""
    left, out = sorted(specs, key=lambda s: -len(s.dims)), []
    while left:
        inside = [s for s in left if set(s.dims) <= set(left[0].dims)][:most]
        left = [s for s in left if s not in inside]
        out.append(tuple(inside))
    return out


def totals_all(conn: DataFrame, specs=TOTALS, strategy: str = "families", unit: str = "hour") -> DataFrame:
    """All totals.

    strategy ``families`` (default): per family of ``families`` a scan, an Expand (3 rows per input row) and a shuffle.
    A task holds the groups of one family, a sixth of all.
    strategy ``grouping_sets``: one scan, one Expand (21 rows per input row), one shuffle.
    strategy ``two_level``: see ``_totals_two_level``.
    strategy ``union``: one aggregate per set, unioned; Spark scans the
    input once per set unless the caller caches it (kept for comparison).
    """
    specs = tuple(specs)
    if strategy == "two_level":
        return _totals_two_level(conn, specs, unit)
    if strategy in ("union", "families"):
        if strategy == "union":
            parts = [totals(conn, s, unit) for s in specs]
        else:
            parts = [_family(conn, f, unit) for f in families(specs)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    if strategy != "grouping_sets":
        raise ValueError(f"unknown strategy {strategy!r}")
    hourly = _with_hour(conn, unit)
    sets = [[F.col(TS), *[F.col(d) for d in s.dims]] for s in specs]
    agg = hourly.groupingSets(sets, F.col(TS), *[F.col(d) for d in DIMENSIONS]).agg(
        *measure_aggregates(), grouping_number().alias("_grouping")
    )
    return _full_layout(agg.withColumn(TIPO, tipo_of_grouping(F.col("_grouping"))), conn)


def _family(conn: DataFrame, specs: tuple[TotalSpec, ...], unit: str) -> DataFrame:
    """The totals of sets nested in the first of them, by one aggregate over its dimensions."""
    if len(specs) == 1:
        return totals(conn, specs[0], unit)
    dims = specs[0].dims
    sets = [[F.col(TS), *[F.col(d) for d in s.dims]] for s in specs]
    agg = _with_hour(conn, unit).groupingSets(sets, F.col(TS), *[F.col(d) for d in dims]).agg(
        *measure_aggregates(), grouping_number(dims).alias("_grouping"))
    return _full_layout(agg.withColumn(TIPO, tipo_of_grouping(F.col("_grouping"))), conn)


def resp_host_counts(resp_h_totals: DataFrame) -> DataFrame:
    """A5: connections per responder host over the RESP_H totals."""
    df = resp_h_totals
    if TIPO in df.columns:
        df = df.where(F.col(TIPO) == F.lit("RESP_H"))
    return df.groupBy(RESP_H).agg(F.sum(COUNT).alias(COUNT))


def top_resp_hosts(resp_h_totals: DataFrame, n: int = 10000) -> DataFrame:
    """T4: the ``n`` busiest responders (ties broken by host)."""
    return resp_host_counts(resp_h_totals).orderBy(F.col(COUNT).desc(), F.col(RESP_H).asc()).limit(n)


def export_order(spec: TotalSpec) -> list[Column]:
    """The export sort of one total, then its remaining dimensions as tie-breaks."""
    keys = list(spec.export_sort) + [d for d in spec.dims if d not in spec.export_sort]
    return [F.col(k).asc_nulls_first() for k in keys]


def export_keys(specs=TOTALS) -> dict[str, Column]:
    """Columns that sort rows of several totals at once: within each TIPO in that total's export order.

    The i-th key of a total is its i-th sort column; texts and numbers have a column each, so that they keep their own order.
    """
    orders = {s.tipo: list(s.export_sort) + [d for d in s.dims if d not in s.export_sort] for s in specs}
    numbers = {ORIG_P, RESP_P}
    out = {}
    for i in range(max(map(len, orders.values()))):
        for kind, wanted in (("time", lambda c: c == TS), ("number", numbers.__contains__), ("text", lambda c: c != TS and c not in numbers)):
            by_column: dict[str, list[str]] = {}
            for tipo, order in orders.items():
                if i < len(order) and wanted(order[i]):
                    by_column.setdefault(order[i], []).append(tipo)
            if by_column:
                key = F
                for column, tipos in by_column.items():
                    key = key.when(F.col(TIPO).isin(tipos), F.col(column))
                out[f"_{kind}{i}"] = key
    return out


def _totals_two_level(conn: DataFrame, specs, unit: str, heavy=(ORIG_P,)) -> DataFrame:
    """Grouping sets in two levels, split on a high-cardinality dimension.

    Sets holding a ``heavy`` dimension (the ephemeral source port: their
    groups barely shrink) are one grouping-sets aggregate over the input
    (Expand x6).  Every other set is a rollup of one base set without the
    heavy dimensions -- (hour, PROTO, SERVICE, ORIG_H, RESP_H, RESP_P) --
    so the input is aggregated once to that grain (no Expand) and a second
    grouping-sets aggregate over the much smaller base derives the other 15
    sets (COUNT and the sums re-aggregate as sums).  Per input row that is
    7 hash-aggregate updates instead of 21, for a second column-pruned scan.
    It pays where the base is much smaller than the input; on the test data
    """
    direct = [s for s in specs if any(d in s.dims for d in heavy)]
    derived = [s for s in specs if not any(d in s.dims for d in heavy)]
    if not derived or not direct:
        return totals_all(conn, specs, "grouping_sets", unit)
    base_dims = [d for d in DIMENSIONS if d not in heavy]
    hourly = _with_hour(conn, unit)
    first = hourly.groupingSets(
        [[F.col(TS), *[F.col(d) for d in s.dims]] for s in direct], F.col(TS), *[F.col(d) for d in DIMENSIONS]
    ).agg(*measure_aggregates(), grouping_number().alias("_grouping"))
    base = hourly.groupBy(TS, *base_dims).agg(*measure_aggregates())
    second = base.groupingSets(
        [[F.col(TS), *[F.col(d) for d in s.dims]] for s in derived], F.col(TS), *[F.col(d) for d in base_dims]
    ).agg(
        F.sum(COUNT).alias(COUNT), *[F.sum(m).alias(m) for m in MEASURES],
        grouping_number(base_dims).alias("_grouping"),
    )
    parts = [_full_layout(df.withColumn(TIPO, tipo_of_grouping(F.col("_grouping"))), conn) for df in (first, second)]
    return parts[0].unionByName(parts[1])
