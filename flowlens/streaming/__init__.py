"""Incremental processing of new LOG files with Structured Streaming."""

from flowlens.streaming.incremental import incremental_totals, run_incremental_totals

__all__ = ["incremental_totals", "run_incremental_totals"]
