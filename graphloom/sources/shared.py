"""Tables in the folder that all executors share.

Lineage is cut by writing a table there, never by blocks held in an executor's own
storage: a lost executor then costs a read, not a recomputation or a failure.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_written: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset and all runs on one machine (tests),
    one of our own. On a cluster a folder of the driver's machine would not do: that is an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = getattr(spark.sparkContext, "_graphloom_root", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="graphloom-shared-")
        spark.sparkContext._graphloom_root = root
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_root(spark)}/graphloom/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As :func:`materialize`, with the number of rows, which are counted as they are written."""
    counted = Observation()
    stored = materialize(df.observe(counted, F.count(F.lit(1)).alias("n")), label)
    return stored, counted.get["n"]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system Spark knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path that were written to their end, in order."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    folders = [status.getPath() for status in system.listStatus(at)]
    return sorted(f.getName() for f in folders if system.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text at a path of any file system, as a whole: under another name first."""
    jvm = spark.sparkContext._jvm
    target, part = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}"))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"{path} could not be put in its place")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text that :func:`write_text` put there; None if there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def cleanup(spark: SparkSession) -> int:
    """Delete what :func:`materialize` wrote in this process; return how many paths."""
    count = len(_written)
    while _written:
        remove(spark, _written.pop())
    return count
