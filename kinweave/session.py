"""Session construction and the settings every plan of the engine relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Settings that matter for the plans: AQE re-plans joins and splits skewed partitions at run time,
#: UTC keeps timestamps comparable with other engines.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "kinweave", master: str | None = None, **conf: str) -> SparkSession:
    """The running session, or a new one. Options are only set where a new session is built."""
    builder = SparkSession.builder.appName(app)
    if master := master or os.environ.get("KINWEAVE_MASTER"):
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that Python functions find it on any cluster."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="kinweave-"), "kinweave.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("kinweave", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(target)
