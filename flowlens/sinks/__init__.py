"""Sinks: CSV / JSON files and keyed-by-run result tables."""

from flowlens.sinks.files import write_csv, write_json
from flowlens.sinks.tables import ResultTable, append_run, read_results, stamp_run, write_results

__all__ = ["ResultTable", "write_csv", "write_json", "write_results", "append_run", "read_results", "stamp_run"]
