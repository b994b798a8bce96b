"""Manifests: which files make up a table, published in one step.

A table's data lies in folders that are written once and never changed, one per
write (``ATTEMPT=...``).  What readers see is named by manifests, small JSON files
under ``_runs/<run>/``: for each kind of the run its folder and number of rows.  A
manifest is written under a temporary name and renamed to the run's next version, so
readers see the old run whole or the new one whole, and a job that dies before the rename
changes nothing.  Two writers of one run cannot both take a version: the later one
reads what the other published and tries again.

Rename must be atomic and refuse an existing target (HDFS and local file systems; on an
object store, use one of its committers that offers this).  All sizes here follow
the number of runs and kinds, not the rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUNS = "_runs"
ATTEMPT = "ATTEMPT"
DAY_MS = 86_400_000


class Manifests:
    """The manifests of the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _p(self, *names: str):
        return self._hadoop.Path("/".join([self.path, *names]))

    def _list(self, *names: str):
        path = self._p(*names)
        return list(self.fs.listStatus(path)) if self.fs.exists(path) else []

    def exists(self) -> bool:
        return self.fs.exists(self._p(RUNS))

    def new_attempt(self) -> str:
        return f"{ATTEMPT}=a{uuid.uuid4().hex}"

    def partitions(self, folder: str, depth: int) -> list[list[str]]:
        """The names below ``folder``, ``depth`` levels down, of folders that hold files."""
        found = self.fs.globStatus(self._p(folder, *["*=*"] * depth))
        out = []
        for s in found or []:
            at, names = s.getPath(), []
            for _ in range(depth):
                names.insert(0, at.getName())
                at = at.getParent()
            out.append(names)
        return out

    def runs(self) -> list[str]:
        """The names of all runs, from one listing."""
        return sorted(s.getPath().getName() for s in self._list(RUNS) if s.isDirectory())

    def newest(self, run: str) -> tuple[int, dict]:
        """(version, content) of a run; version 0 with nothing in it if there is none."""
        names = [s.getPath().getName() for s in self._list(RUNS, run)]
        versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not versions:
            return 0, {"kinds": {}}
        stream = self.fs.open(self._p(RUNS, run, f"{max(versions):08d}.json"))
        try:
            return max(versions), json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def publish(self, run: str, version: int, content: dict) -> bool:
        """Make ``content`` the version after ``version``; False if another writer was first."""
        hidden, target = self._p(RUNS, run, f".{uuid.uuid4().hex}"), self._p(RUNS, run, f"{version + 1:08d}.json")
        out = self.fs.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        options = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        context = self._hadoop.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(context.makeQualified(hidden), context.makeQualified(target), options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            self.fs.delete(hidden, False)
            return False

    def update(self, run: str, change: Callable[[dict], dict | None]) -> bool:
        """Publish ``change(content)`` over the newest content, again if another writer came between; None: leave it as it is."""
        while True:
            version, content = self.newest(run)
            after = change(content)
            if after is None:
                return False
            if self.publish(run, version, after):
                return True

    def frame(self, contents: list[dict]) -> DataFrame | None:
        """The rows of the folders that ``contents`` name, or None if no schema is known."""
        schemas = [T.StructType.fromJson(c["schema"]) for c in contents if "schema" in c]
        if not schemas:
            return None
        fields: dict[str, T.StructField] = {}
        for schema in schemas:
            fields |= {f.name: T.StructField(f.name, f.dataType, True) for f in schema}
        whole = T.StructType(list(fields.values()))
        folders = [f"{self.path}/{kind['folder']}" for c in contents for kind in c["kinds"].values()]
        if not folders:
            return self.spark.createDataFrame([], whole)
        read = self.spark.read.schema(T.StructType([*whole.fields, T.StructField(ATTEMPT, T.StringType())]))
        return read.option("basePath", self.path).parquet(*folders).select(*whole.names)

    def vacuum(self, older_than_ms: int = DAY_MS) -> list[str]:
        """Delete what no newest manifest names and what is older than ``older_than_ms`` (a job or reader may still use younger files)."""
        used = {kind["folder"].split("/")[0] for run in self.runs() for kind in self.newest(run)[1]["kinds"].values()}
        limit, gone = time.time() * 1000 - older_than_ms, []
        for s in self._list():
            name = s.getPath().getName()
            if name.startswith(f"{ATTEMPT}=") and name not in used and s.getModificationTime() < limit:
                self.fs.delete(s.getPath(), True)
                gone.append(name)
        for run in self.runs():
            last = f"{self.newest(run)[0]:08d}.json"
            for s in self._list(RUNS, run):
                if s.getPath().getName() != last and s.getModificationTime() < limit:
                    self.fs.delete(s.getPath(), False)
        return gone
