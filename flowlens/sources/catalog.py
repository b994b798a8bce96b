"""A catalog of named tables (format, path, options) read with spark.read.

Originally every table is read through one connector configured with a
table name.  Here a table is any Spark-readable location; Parquet tables
partitioned by ``TIPO`` (and a run or ingest date) give partition pruning
for free.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSource:
    path: str
    format: str = "parquet"
    options: dict = field(default_factory=dict)


class Catalog:
    """Name -> TableSource.  ``read`` returns a lazy DataFrame."""

    def __init__(self, tables: dict[str, TableSource | str] | None = None):
        self._tables: dict[str, TableSource] = {}
        for name, src in (tables or {}).items():
            self.add(name, src)

    def add(self, name: str, source: TableSource | str) -> "Catalog":
        self._tables[name.upper()] = source if isinstance(source, TableSource) else TableSource(source)
        return self

    def source(self, name: str) -> TableSource:
        try:
            return self._tables[name.upper()]
        except KeyError:
            raise KeyError(f"table {name!r} is not in the catalog: {sorted(self._tables)}") from None

    def __contains__(self, name: str) -> bool:
        return name.upper() in self._tables

    def names(self) -> list[str]:
        return sorted(self._tables)

    def read(self, spark: SparkSession, name: str, schema=None) -> DataFrame:
        src = self.source(name)
        reader = spark.read.format(src.format).options(**src.options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(src.path)

    def register_views(self, spark: SparkSession) -> None:
        """Expose every table as a temp view for SQL users."""
        for name in self._tables:
            self.read(spark, name).createOrReplaceTempView(name)
