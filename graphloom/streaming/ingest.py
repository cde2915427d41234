"""Manifests as a stream of files: every file once, in any order, however late.

The file source forgets files older than ``maxFileAge``; that default would drop late
manifests for ever, so it is set beyond any age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.plans.ingest import Lake
from graphloom.schemas import MANIFEST
from graphloom.sources.manifests import MANIFEST_FILES

NO_AGE = "36500d"


def manifest_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(MANIFEST).option("maxFileAge", NO_AGE).option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", MANIFEST_FILES).option("recursiveFileLookup", "true").json(f"{root.rstrip('/')}/raw")
        .select("*", F.regexp_extract("_metadata.file_path", r"(raw/.*)$", 1).alias("manifest_key"))
    )


def run_available(lake: Lake, root: str, documents: DataFrame, checkpoint: str, files_per_batch: int = 1000, seconds: int | None = None) -> list[dict]:
    """Load all manifests there are and stop. A batch that died is run again with the same files;
    latest-wins folds what it had already appended. ``seconds`` ends the run at a deadline."""
    results: list[dict] = []

    def load(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            results.append(lake.load(batch.withColumn("line", F.monotonically_increasing_id()), documents))

    query = (
        manifest_stream(lake.spark, root, files_per_batch).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if query.awaitTermination(seconds) is False:
        query.stop()
    return results
