"""V1-V3: counts over time by one dimension, in long form or pivoted.

``long_counts`` is the complete result: a row for each (bucket, value), for
any number of values, as one aggregate with map-side combine.

``pivot_counts`` is the wide form: a column for each of the values the caller
gives (or the ``most`` values with the largest totals, taken from a stored
long form) and a column ``OTHER`` for all the rest.  So no count is lost:
the cells of a row add up to its bucket's total.

Buckets are timestamps; a null value gives a column named ``null``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.time import bucket
from flowlens.schemas import COUNT, TS
from flowlens.session import reliable_checkpoint

OTHER = "OTHER"


def long_counts(df: DataFrame, dim: str, unit: str = "hour", value_col: str = COUNT,
                time_col: str = TS, where=None, keys=()) -> DataFrame:
    """(TS bucket, dim, COUNT) rows, over all values of ``dim``; ``keys``: further columns to count apart by."""
    if where is not None:
        df = df.where(where)
    return (
        df.select(bucket(df, time_col, unit).alias(TS), dim, value_col, *keys)
        .groupBy(TS, dim, *keys)
        .agg(F.sum(value_col).alias(COUNT))
    )


def top_values(long: DataFrame, dim: str, n: int) -> list:
    """The ``n`` values of ``dim`` with the largest total (ties by value), n rows."""
    rows = (
        long.groupBy(dim).agg(F.sum(COUNT).alias("_total"))
        .orderBy(F.col("_total").desc_nulls_last(), F.col(dim).asc_nulls_first())
        .limit(n)
        .collect()
    )
    return [r[dim] for r in rows]


def wide(long: DataFrame, dim: str, values: list, keys=()) -> DataFrame:
    """One row per bucket (and ``keys``) of ``long``: a column for each of ``values`` and OTHER."""
    def is_(v):
        return F.col(dim).isNull() if v is None else F.col(dim) == F.lit(v)

    named = [F.sum(F.when(is_(v), F.col(COUNT))).alias("null" if v is None else str(v)) for v in values]
    rest = F.lit(True)
    for v in values:
        rest = rest & ~F.coalesce(is_(v), F.lit(False))
    return long.groupBy(TS, *keys).agg(*named, F.sum(F.when(rest, F.col(COUNT))).alias(OTHER))


def pivot_counts(df: DataFrame, dim: str, unit: str = "hour", values: list | None = None, most: int = 100,
                 value_col: str = COUNT, time_col: str = TS, where=None) -> DataFrame:
    """One row per time bucket, one column per value of ``dim`` and OTHER: sums of ``value_col``."""
    long = long_counts(df, dim, unit, value_col, time_col, where)
    if values is None:
        long = reliable_checkpoint(long)  # read twice: for the values and for the cells
        values = top_values(long, dim, most)
    return wide(long, dim, values)
