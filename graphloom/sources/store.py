"""State tables as numbered versions with appended parts: a reader sees what is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.schemas import PARTITION, QUEUE
from graphloom.sources.shared import complete_folders, remove

STATE = {
    "queue": QUEUE + ", url string, has_meta boolean",
    "partitions": PARTITION,
    "cursors": "source string, stream string, cursor string, frontier_id string, updated_at timestamp",
    "blobs": "sha256 string, kind_class string, kind string, bytes int, bucket_key string, expires_at timestamp",
    "requests": "host string, ts timestamp, status int",
    "clears": "host string, cleared_at timestamp, cleared_by string",
    "runs": "run_id string, job string, started_at timestamp, finished_at timestamp, items bigint, error string",
    "migrations": "number int, name string, checksum string, applied_at timestamp",
}
#: Appended parts after which a table is written as a new version.
MOST_PARTS = 64


class StateStore:
    """Tables of STATE below a path of any file system. A version is a folder ``v<number>``; rows appended
    to it are folders ``v<number>-<part>`` beside it, so appending writes the new rows only. A folder
    counts once its ``_SUCCESS`` is there, so a writer that dies leaves the state as it was. One writer
    a table at a time, as jobs have by their leases."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self, name: str) -> tuple[int, list[str], list[str]]:
        """(newest version, its folders, folders of older versions)."""
        found = [f for f in complete_folders(self.spark, f"{self.path}/{name}") if f.startswith("v")]
        number = lambda f: int(f[1:].split("-")[0])
        newest = max((number(f) for f in found if "-" not in f), default=0)
        return newest, [f for f in found if number(f) == newest], [f for f in found if number(f) < newest]

    def _columns(self, name: str) -> list[str]:
        return [c.split()[0] for c in STATE[name].split(", ")]

    def read(self, name: str) -> DataFrame:
        _, folders, _ = self._folders(name)
        if not folders:
            return self.spark.createDataFrame([], STATE[name])
        return self.spark.read.schema(STATE[name]).parquet(*[f"{self.path}/{name}/{f}" for f in folders])

    def write(self, name: str, rows: DataFrame) -> None:
        """Put a whole new version; the one before stays for readers that have it open."""
        newest, _, older = self._folders(name)
        rows.select(*self._columns(name)).write.mode("overwrite").parquet(f"{self.path}/{name}/v{newest + 1:09d}")
        for folder in older:
            remove(self.spark, f"{self.path}/{name}/{folder}")

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows; columns they lack are null. After MOST_PARTS times the table is written anew."""
        newest, folders, _ = self._folders(name)
        empty = self.spark.createDataFrame([], STATE[name])
        added = empty.unionByName(rows, allowMissingColumns=True).select(*self._columns(name))
        if not folders or len(folders) > MOST_PARTS:
            self.write(name, self.read(name).unionByName(added))
            return
        part = max(int((f.split("-") + ["0"])[1]) for f in folders) + 1
        added.write.mode("overwrite").parquet(f"{self.path}/{name}/v{newest:09d}-{part:06d}")
