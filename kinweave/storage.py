"""Cutting lineage through tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder for written intermediates: spark.checkpoint.dir where the session has it, else a temporary one, on a local
    master only: on a cluster every executor would write to a disk of its own."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = _roots.get("") or "file://" + tempfile.mkdtemp(prefix="kinweave-")
        _roots[""] = conf
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{conf.rstrip('/')}/kinweave-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001 - the JVM may be gone at exit
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Lets Spark delete a query's shuffle files when the query ends instead of when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Written:
    """A DataFrame written to the shared folder and read back: its plan starts at files that outlive any executor.

    The shuffle files behind it are of no more use once it's written and are deleted at once.
    """

    def __init__(self, df: DataFrame, name: str = "t"):
        self.spark = df.sparkSession
        self.path = f"{shared_root(self.spark)}/{name}-{uuid.uuid4().hex[:10]}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes and reads back; the files are removed when the process ends."""
    return Written(df, name).df
