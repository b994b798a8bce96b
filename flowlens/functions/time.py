"""Time buckets, stamps and text labels.

Buckets are ``date_trunc`` results cast back to the input's timestamp type
(``date_trunc`` on TIMESTAMP_NTZ returns TIMESTAMP), never a
format-then-parse round trip.  Text labels (``dd.MM.yyyy HH`` and so on)
are produced only at the export edge by ``label``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = ("minute", "hour", "day")

# Label formats of the exports (fixed values).
LABEL_FORMATS = {
    "minute": "dd.MM.yyyy HH:mm",
    "hour": "dd.MM.yyyy HH",
    "day": "dd.MM.yyyy",
}


def bucket(df: DataFrame, column: str, unit: str) -> Column:
    """Truncate ``column`` to ``unit``, keeping its timestamp type."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    dtype = df.schema[column].dataType
    return F.date_trunc(unit, F.col(column)).cast(dtype)


def label(column: str | Column, unit: str) -> Column:
    """Text label of a bucket as the exports print it."""
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, LABEL_FORMATS[unit])


def parse_stamp(stamp: str | dt.datetime | dt.date) -> dt.datetime:
    """Parse a stamp such as ``2018-12-02 21:57:00.000`` (no time zone)."""
    if isinstance(stamp, dt.datetime):
        return stamp.replace(tzinfo=None)
    if isinstance(stamp, dt.date):
        return dt.datetime(stamp.year, stamp.month, stamp.day)
    return dt.datetime.fromisoformat(str(stamp).strip())


def since_literal(df: DataFrame, column: str, stamp) -> Column:
    """A literal of the same timestamp type as ``column`` for ``stamp``.

    Parsing happens once on the driver; the comparison stays a plain
    timestamp predicate that Parquet can push down.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_literal(stamp)
    # TIMESTAMP (local time zone): read the wall-clock stamp in the session zone.
    return F.lit(parse_stamp(stamp).isoformat(sep=" ")).cast(T.TimestampType())


def ntz_literal(stamp) -> Column:
    """A TIMESTAMP_NTZ literal of a wall-clock stamp.

    Built from text, so neither the Python process zone nor the session
    zone shifts it (a ``lit(datetime)`` is read in the local zone first).
    """
    return F.lit(parse_stamp(stamp).isoformat(sep=" ")).cast(T.TimestampNTZType())
