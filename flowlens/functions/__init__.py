"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from flowlens.functions.time import bucket, label, ntz_literal, parse_stamp, since_literal
from flowlens.functions.grouping import grouping_number, tipo_of_grouping

__all__ = ["bucket", "label", "ntz_literal", "since_literal", "parse_stamp", "grouping_number", "tipo_of_grouping"]
