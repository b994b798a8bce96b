"""The IP_INFO cache as a bucketed, compacted table with the newer runs beside it.

Lookups are added as run partitions (``RUN_ID=...``, ``sinks.append_run``), so the cache grows by a few files a run, with several
rows for an IP.  ``compact`` brings the runs up to a moment into one table bucketed and sorted by
IP, with one row for each: the newest successful lookup, or the newest failed attempt if there is none.  Joins on
IP then read the cache side in place, without a shuffle.  Attempts after ``before`` stay as they are, so the quota of a
day counts them; hits, misses and attached attributes are the same before and after.

The table of a compaction is a new folder, published by manifest; readers of the older one are not disturbed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.time import since_literal
from flowlens.schemas import IP, TS_CODE
from flowlens.sinks.manifests import Manifests

COMPACT = "COMPACT"
BUCKETS = 64
LOOKUP_OK = "LOOKUP_OK"
RUN_ID = "RUN_ID"


class LookupCache:
    """The cache at ``path``, partitioned by RUN_ID."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.manifests = spark, Manifests(spark, path)

    def _runs(self) -> dict[int, str]:
        m = self.manifests
        return {int(p[0].split("=")[1]): f"{m.path}/{p[0]}" for p in m.partitions(".", 1) if p[0].startswith(f"{RUN_ID}=")}

    def is_empty(self) -> bool:
        return not self._runs() and COMPACT not in self.manifests.newest(COMPACT)[1]["kinds"]

    def _read_runs(self, folders: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.manifests.path).parquet(*folders)

    def _compacted(self, content: dict) -> DataFrame:
        """The bucketed table, known to this session's catalog under a name of its own."""
        info = content["kinds"][COMPACT]
        folder = f"{self.manifests.path}/{info['folder']}"
        name = "flowlens_ip_" + hashlib.md5(folder.encode()).hexdigest()
        if not self.spark.catalog.tableExists(name):
            fields = T.StructType.fromJson(content["schema"])
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            place = self.manifests._p(info["folder"]).makeQualified(self.manifests.fs.getUri(), self.manifests.fs.getWorkingDirectory()).toString()
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({IP}) SORTED BY ({IP}) "
                           f"INTO {info['buckets']} BUCKETS LOCATION '{place}'")
        return self.spark.table(name)

    def read(self) -> DataFrame:
        """All rows: the compacted table, and the runs added since."""
        _, content = self.manifests.newest(COMPACT)
        runs = self._runs()
        if COMPACT not in content["kinds"]:
            return self._read_runs(list(runs.values()))
        base = self._compacted(content)
        later = [folder for run, folder in runs.items() if run not in set(content["runs"])]
        return base.unionByName(self._read_runs(later).select(base.columns)) if later else base

    def compact(self, before, buckets: int | None = None) -> int:
        """Bring the runs whose attempts are all at or before ``before`` into the bucketed table; the number of runs.

        ``buckets``: by default as many as the session's shuffle partitions, 64 at least; with fewer Spark would
        rather shuffle both sides of a join than read the buckets in place.
        One scan of a run's newest stamp decides; run folders that became part of the table are deleted by ``vacuum``.
        """
        if buckets is None:
            buckets = max(BUCKETS, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        version, content = self.manifests.newest(COMPACT)
        known, runs = set(content.get("runs", [])), self._runs()
        waiting = {run: folder for run, folder in runs.items() if run not in known}
        if not waiting:
            return 0
        rows = self._read_runs(list(waiting.values()))
        newest = rows.groupBy(RUN_ID).agg(F.max(TS_CODE).alias(TS_CODE))
        late = {r[0] for r in newest.where(F.col(TS_CODE) > since_literal(rows, TS_CODE, before)).select(RUN_ID).collect()}  # a row a run
        ready = [run for run in waiting if run not in late]
        if not ready:
            return 0
        rows = rows.where(F.col(RUN_ID).isin(ready))
        if LOOKUP_OK not in rows.columns:
            rows = rows.withColumn(LOOKUP_OK, F.lit(True))
        rows = rows.withColumn(RUN_ID, F.col(RUN_ID).cast("long"))
        if COMPACT in content["kinds"]:
            rows = rows.unionByName(self._compacted(content).select(rows.columns))
        rest = [c for c in rows.columns if c not in (IP, LOOKUP_OK, TS_CODE)]
        ok = F.coalesce(F.col(LOOKUP_OK), F.lit(True))
        best = F.max(F.struct(ok.alias(LOOKUP_OK), TS_CODE, *rest)).alias("_best")
        one = rows.groupBy(IP).agg(best).select(IP, "_best.*")
        folder, name = f"_compact/{uuid.uuid4().hex}", f"flowlens_ip_write_{uuid.uuid4().hex}"
        place = self.manifests._p(folder).makeQualified(self.manifests.fs.getUri(), self.manifests.fs.getWorkingDirectory()).toString()
        one.repartition(buckets, IP).write.format("parquet").bucketBy(buckets, IP).sortBy(IP).option("path", place).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        after = {"kinds": {COMPACT: {"folder": folder, "buckets": buckets}}, "runs": sorted(known | set(ready)), "schema": one.schema.jsonValue()}
        if not self.manifests.publish(COMPACT, version, after):
            raise RuntimeError(f"another compaction of {self.manifests.path} was published first")
        return len(ready)

    def vacuum(self) -> list[str]:
        """Delete run folders that are part of the compacted table, and tables of older compactions."""
        _, content = self.manifests.newest(COMPACT)
        if COMPACT not in content["kinds"]:
            return []
        m, gone = self.manifests, []
        old = [folder for run, folder in self._runs().items() if run in set(content["runs"])]
        old += [s.getPath().toString() for s in m._list("_compact") if not content["kinds"][COMPACT]["folder"].endswith(s.getPath().getName())]
        for folder in old:
            m.fs.delete(m._hadoop.Path(folder), True)
            gone.append(folder)
        return gone
