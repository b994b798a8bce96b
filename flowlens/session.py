"""Session helpers: the settings the library's plans rely on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library expects. They are applied by
# ``builder`` for local runs and tests; on a cluster the caller's session
# should carry the same values (``configure`` sets the runtime ones).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE joins small partitions but cannot split those of an aggregate: a
    # task holds no more than a share of this size, whatever the session's
    # number of shuffle partitions, and reads so much of a file at most.
    # Partitions are joined to that much, too: what one task stores, one reads.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs an extra shuffle later (J1's
    # DISTINCT sits on the join's partitioning; without this AQE skips it).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def builder(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "flowlens"):
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Many different plans run in one session (21 totals, exports, jobs):
        # keep their generated classes instead of recompiling after eviction.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in RUNTIME_CONF.items():
        b = b.config(key, value)
    return b


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = builder(f"local[{cpus}]", shuffle_partitions).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``), for sessions whose workers cannot import it from their own path."""
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="flowlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "flowlens"), "zip", os.path.dirname(here), os.path.basename(here)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in spark.checkpoint.dir.

    On a cluster that setting points at shared storage and is used as is;
    a cluster session without it raises.  Only a local session (one machine,
    one JVM) gets a scratch folder, removed when Python exits.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        configured = _local_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder for master {master}")
    folder = tempfile.mkdtemp(prefix="flowlens-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def reliable_checkpoint(df, columns=None):
    """Write ``df`` (or only ``columns``) once as Parquet in the checkpoint folder and return a frame that reads it.

    The lineage ends there, a lost executor costs a re-read, and unlike an
    RDD checkpoint the reader still prunes columns and pushes filters down.
    """
    spark = df.sparkSession
    if columns is not None:
        df = df.select(*columns)
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Delete the files of a frame made by ``reliable_checkpoint`` that no later job reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/stored-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark, path: str) -> bool:
    """Whether ``path`` exists, asked of its own file system (local, default or named by a scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
