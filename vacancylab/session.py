"""Spark session and checkpoint-directory helpers.

The library never owns the cluster configuration: ``get_spark`` only fills in
settings that are still unset, so a cluster's own ``spark-defaults`` win.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on.  Applied only where the session has no value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one employer / one boilerplate text may hold a third of all rows:
    # AQE splits such partitions on the big side of a join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small selective join sides (tags, samples) prune the big side's scan
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


STATIC_KEYS = {"spark.ui.enabled"}


def get_spark(app_name: str = "vacancylab", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    Defaults never override what the cluster set (spark-defaults / --conf);
    ``master``, ``shuffle_partitions`` and ``extra_conf`` are explicit
    requests for local runs and tests - on a cluster leave them unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    explicit = dict(extra_conf or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in explicit.items():
        builder = builder.config(key, value)
    # the web UI is a server; it stays off unless explicitly requested
    if "spark.ui.enabled" not in explicit:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    preset = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if key in explicit or key in STATIC_KEYS or preset.contains(key):
            continue
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``vacancylab`` importable in Python workers (pandas UDFs are
    pickled by module reference): zip the package once per driver process
    and ``addPyFile`` it, so executors on any host receive it."""
    import os
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="vacancylab-pkg-"), "vacancylab.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED[key] = zpath


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system path).  Only local runs without that setting get a fresh temporary
    folder, which is never appropriate on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not fallback and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = fallback or tempfile.mkdtemp(prefix="vacancylab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def land_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and read it back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one pass lands below the checkpoint folder and no longer needs at its end.

    Inside the ``with`` block a query's shuffle files go when the query ends
    (a lost one is made again), and ``drop`` deletes a table that a later one
    replaced, so disk holds what the pass still reads and not its history."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, f"{name}-{uuid.uuid4().hex}", {}

    def __enter__(self) -> Scratch:
        self.root = f"{ensure_checkpoint_dir(self.spark)}/{self.folder}"
        self.before = self.spark.conf.get(self.CLEANUP, None)
        self.spark.conf.set(self.CLEANUP, "true")
        return self

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(self.CLEANUP)
        else:
            self.spark.conf.set(self.CLEANUP, self.before)
        self._delete(self.root)

    def land(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        """``df`` written once as Parquet and read back."""
        path = f"{self.root}/{len(self.paths)}"
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
        landed = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = landed
        return landed

    def drop(self, *tables: DataFrame) -> None:
        """Delete landed tables that nothing reads any more (others are left alone)."""
        for path, landed in self.paths.items():
            if any(landed is t for t in tables):
                self.paths[path] = None
                self._delete(path)

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
