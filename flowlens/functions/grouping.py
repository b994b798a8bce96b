"""Grouping numbers and the TIPO name of each grouping set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.schemas import DIMENSION_WEIGHT, TOTALS


def grouping_number(grouped=None) -> Column:
    """Sum of ``grouping(c) * weight`` over the six dimensions.

    Built from ``grouping`` terms rather than ``grouping_id`` because the
    latter wants the full grouping list, including the time bucket.  A
    dimension that is null in the data is told apart from a rolled-up one.
    ``grouped`` lists the dimensions in the aggregate's grouping columns;
    any other dimension counts as always rolled up.
    """
    grouped = set(DIMENSION_WEIGHT if grouped is None else grouped)
    terms = [F.grouping(c) * F.lit(w) if c in grouped else F.lit(w) for c, w in DIMENSION_WEIGHT.items()]
    return reduce(lambda a, b: a + b, terms)


def tipo_of_grouping(number: Column) -> Column:
    """Map a grouping number to its TIPO name (21 fixed cases)."""
    expr = None
    for spec in TOTALS:
        cond = number == F.lit(spec.grouping_bits)
        expr = F.when(cond, F.lit(spec.tipo)) if expr is None else expr.when(cond, F.lit(spec.tipo))
    return expr
