"""Table sources: catalog, fixture views and the scans over them."""

from flowlens.sources.catalog import Catalog, TableSource
from flowlens.sources import fixtures, scans

__all__ = ["Catalog", "TableSource", "fixtures", "scans"]
