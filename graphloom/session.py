"""Session settings and shipping of this package to executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What every plan here relies on; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a batch of very long texts must fit a Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName("graphloom")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once a session.

    Executors that join later, for instance in the place of lost ones, fetch it too.
    """
    context = spark.sparkContext
    if getattr(context, "_graphloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="graphloom-"))
    shutil.copytree(root, target / "tree" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(target / "graphloom"), "zip", target / "tree")
    context.addPyFile(archive)
    context._graphloom_shipped = True
