"""All-time totals: the sums of all runs, merged run by run.

The state has a row for each (TIPO, hour, dimensions), stored by day and TIPO.  A run's totals
are merged by adding them to the rows of the days they touch: those days are read, summed
with the run and written to a new folder; other days stay where they are.  The manifest
that names the new folders also names the run, so a run is merged once, however often it
is replayed, and a job that dies before publishing changes nothing.  Of two writers the later one merges again, on
top of the other.  COUNT and the seven sums add up, so any split of the rows into runs gives the totals of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.schemas import COUNT, DIMENSIONS, MEASURES, TIPO, TOTALS_COLUMNS, TS
from flowlens.session import discard, reliable_checkpoint
from flowlens.sinks.manifests import Manifests

DAY = "DAY"
STATE = "STATE"


class TotalsState:
    """The merged totals at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.manifests = spark, Manifests(spark, path)

    def applied(self) -> list[str]:
        """The runs that are part of the state."""
        return self.manifests.newest(STATE)[1].get("applied", [])

    def merge(self, totals: DataFrame, run: str) -> bool:
        """Add the totals of ``run`` (TOTALS_COLUMNS), unless it is part of the state; whether it was added."""
        if run in self.applied():
            return False
        day = F.date_format(TS, "yyyy-MM-dd").alias(DAY)
        fresh = reliable_checkpoint(totals.select(*TOTALS_COLUMNS, day))
        days = [r[0] for r in fresh.select(DAY).distinct().collect()]  # the days that a run touches
        try:
            while True:
                version, content = self.manifests.newest(STATE)
                if run in content.get("applied", []):
                    return False
                after = self._merged(fresh, days, content)
                if self.manifests.publish(STATE, version, after | {"applied": [*content.get("applied", []), run]}):
                    return True
        finally:
            discard(fresh)

    def _merged(self, fresh: DataFrame, days: list[str], content: dict) -> dict:
        old = self.manifests.frame([content | {"kinds": {d: v for d, v in content["kinds"].items() if d in days}}])
        both = fresh if old is None else fresh.unionByName(old.select(fresh.columns))
        keys = [TIPO, TS, *DIMENSIONS, DAY]
        summed = both.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in (COUNT, *MEASURES))).select(fresh.columns)
        schema = T.StructType([f for f in summed.schema if f.name not in (DAY, TIPO)] + [summed.schema[DAY], summed.schema[TIPO]])
        attempt = self.manifests.new_attempt()
        (summed.hint("rebalance", F.col(DAY), F.col(TIPO)).write.partitionBy(DAY, TIPO)
         .parquet(f"{self.manifests.path}/{attempt}"))
        written = {p[0].split("=", 1)[1]: {"folder": f"{attempt}/{p[0]}"} for p in self.manifests.partitions(attempt, 1)}
        return {"kinds": content["kinds"] | written, "schema": schema.jsonValue()}

    def read(self, tipo: str | None = None) -> DataFrame:
        """The totals of all merged runs, of one TIPO or all."""
        rows = self.manifests.frame([self.manifests.newest(STATE)[1]])
        if rows is None:
            raise ValueError(f"no run was merged at {self.manifests.path}")
        rows = rows if tipo is None else rows.where(F.col(TIPO) == F.lit(tipo))
        return rows.select(*TOTALS_COLUMNS)
