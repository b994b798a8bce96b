"""Analyses over the connection log: totals, web names, per-minute
aggregates, clustering, IP enrichment and pivots."""
