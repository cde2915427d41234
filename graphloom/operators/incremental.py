"""Processing only what is new or changed since the last successful run.

Input comes in partitions (a source and month) and lies in folders by the run that first saw it,
so a run reads what arrived for it and nothing before. The store holds, by partition, the latest
version of each record and a fingerprint: the number of rows and the sum of their hashes, which
is additive, so that of a run is that of the run before plus what arrived. A run works on the
partitions whose fingerprint is not the stored one and no other. It writes in this order: what is
new or changed, in a folder of the run; the changed partitions, each replaced as a whole by
dynamic partition overwrite; the fingerprints. A run that dies at any place is run again: the
list of changes is taken as it is if it is complete, and fingerprints come last. One that died while
it replaced partitions has left a note, and its partitions are built anew from all their rows. So
nothing is skipped and nothing appears twice.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.operators.skew import small_join
from graphloom.sources.shared import complete_folders, exists, materialize, read_text, remove, write_text

VERSIONS = "record_key string, version string, content string, part string, run_seq int"
LATEST = "record_key string, version string, content string, part string"
CHANGES = "record_key string"
#: Pairs of partition and run whose sums come to the driver at once.
MOST_SUMS = 1_000_000
#: Records of one run up to which their keys go to every task that reads the store.
BROADCAST_KEYS = 500_000


def arrivals(manifests: DataFrame, runs: DataFrame) -> DataFrame:
    """(manifest_key, run_seq): the first successful run that started at or after a manifest
    landed. The earliest of several landings counts; manifests that no run has seen yet, and
    rows with a null key or time, are left out. Runs count in the order of their start; of
    equal starts the smaller run_seq is first. Only status ``done`` is a success.

    The range condition is made an equality of days, so neither side has a size limit.
    """
    first_landing = (
        manifests.filter(F.col("manifest_key").isNotNull() & F.col("landed_at").isNotNull())
        .groupBy("manifest_key")
        .agg(F.min("landed_at").alias("landed_at"))
    )
    order = Window.orderBy("started_at", "run_seq")  # run records only, one a run
    done = successful(runs).withColumn("after", F.lag("started_at").over(order))
    first = done.agg(F.to_date(F.min("started_at")).alias("day")).head()["day"]
    if first is None:
        return first_landing.select("manifest_key", F.lit(None).cast("int").alias("run_seq")).limit(0)
    spans = done.withColumn(
        "day", F.explode(F.sequence(F.to_date(F.coalesce("after", "started_at")), F.to_date("started_at")))
    )
    keyed = first_landing.withColumn("day", F.greatest(F.to_date("landed_at"), F.lit(first)))
    seen = (F.col("landed_at") <= F.col("started_at")) & (F.col("after").isNull() | (F.col("landed_at") > F.col("after")))
    return keyed.join(spans, "day").filter(seen).select("manifest_key", "run_seq")


def successful(runs: DataFrame) -> DataFrame:
    """(run_seq, started_at) of the runs that took effect."""
    return runs.filter((F.lower(F.trim("status")) == "done") & F.col("started_at").isNotNull()).select(F.col("run_seq").cast("int").alias("run_seq"), "started_at")


def run_order(runs: DataFrame) -> list[int]:
    """The successful runs in the order of their start: one number a run."""
    return [r["run_seq"] for r in successful(runs).orderBy("started_at", "run_seq").collect()]


def stage(rows: DataFrame, seen: DataFrame, key: str, version: Column, content: Column, part: Column) -> DataFrame:
    """Rows of VERSIONS, stored in a folder for each run: of each record the latest version that each
    run brought in each partition. ``rows`` has ``manifest_key``; rows with a null key, version or
    partition are ignored. Rows of one record with the same version are taken to have the same
    content; if not, the larger content wins. ``seen`` should be stored."""
    narrow = rows.select(
        F.col(key).alias("record_key"), version.alias("version"), content.alias("content"), part.alias("part"), "manifest_key"
    ).filter(F.col("record_key").isNotNull() & F.col("version").isNotNull() & F.col("part").isNotNull())
    latest = (
        small_join(narrow, seen, ["manifest_key"], ["record_key"], "inner")
        .groupBy("record_key", "part", "run_seq")
        .agg(F.max(F.struct("version", "content")).alias("best"))
        .select("record_key", "best.version", "best.content", "part", "run_seq")
    )
    return materialize(latest, "versions", "run_seq")


class ChangeStore:
    """The store at a path; see the module. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def fingerprints(self) -> tuple[int, dict[str, tuple[int, int]]]:
        """The number of the last run that ended, 0 for none, and its fingerprint of each partition."""
        text = read_text(self.spark, f"{self.path}/fingerprints.json")
        held = json.loads(text) if text is not None else {"run": 0, "parts": {}}
        return held["run"], {p: (n, h) for p, (n, h) in held["parts"].items()}

    def _latest(self) -> DataFrame:
        at = f"{self.path}/latest"
        if not exists(self.spark, at):
            return self.spark.createDataFrame([], LATEST)
        return self.spark.read.schema(LATEST).parquet(at)

    def _changes(self, number: int) -> str:
        return f"{self.path}/changes/run-{number:09d}"

    def apply(self, number: int, staged: DataFrame, runs: list[int], expected: dict[str, tuple[int, int]], now: dict[str, tuple[int, int]]) -> list[str]:
        """The last of ``runs``, the ``number``-th: ``now`` are the fingerprints of all partitions with
        what arrived for it, ``expected`` those without. Of a partition whose stored fingerprint is
        not the expected one (rows came to an older file) all rows are read again. Returns the
        partitions that were worked on."""
        _, stored = self.fingerprints()
        changed = sorted(p for p, mark in now.items() if stored.get(p) != mark)
        note = f"{self.path}/replacing-{number:09d}"
        broken = read_text(self.spark, note) is not None
        stale = changed if broken else [p for p in changed if stored.get(p) != expected.get(p)]
        if changed:
            wanted = F.col("part").isin(changed) & (F.col("run_seq") == runs[-1])
            if stale:
                wanted = wanted | (F.col("part").isin(stale) & F.col("run_seq").isin(runs))
            arrived, held = staged.filter(wanted).drop("run_seq"), self._latest()
            if self._changes(number).rsplit("/", 1)[1] not in complete_folders(self.spark, f"{self.path}/changes"):
                came = sum(mark[0] - expected.get(p, (0, 0))[0] for p, mark in now.items()) if not stale else BROADCAST_KEYS + 1
                self._write_changes(number, arrived, held, came <= BROADCAST_KEYS)
            write_text(self.spark, note, "")
            self._replace(arrived, held.filter(~F.col("part").isin(stale)) if stale else held, changed)
        write_text(self.spark, f"{self.path}/fingerprints.json", json.dumps({"run": number, "parts": now}))
        if changed:
            remove(self.spark, note)
        return changed

    def _write_changes(self, number: int, arrived: DataFrame, held: DataFrame, few: bool) -> None:
        """Records that are new, or whose latest version has another content than before. ``few``: there
        are at most BROADCAST_KEYS of them, by the sums."""
        keys = arrived.select("record_key").distinct()
        known = held.join(F.broadcast(keys) if few else keys, "record_key", "left_semi")
        # both sides in one aggregate: each record is sent once from each task
        best, none = F.struct("version", "content"), F.lit(None).cast("struct<version: string, content: string>")
        both = arrived.select("record_key", best.alias("came"), none.alias("held")).unionByName(known.select("record_key", none.alias("came"), best.alias("held")))
        both = both.groupBy("record_key").agg(F.max("came").alias("came"), F.max("held").alias("held"))
        newer = F.col("held").isNull() | ((F.col("came") > F.col("held")) & ~F.col("came.content").eqNullSafe(F.col("held.content")))
        both.filter(newer).select("record_key").write.mode("overwrite").parquet(self._changes(number))

    def _replace(self, arrived: DataFrame, held: DataFrame, changed: list[str]) -> None:
        merged = (
            held.filter(F.col("part").isin(changed)).unionByName(arrived)
            .groupBy("record_key", "part").agg(F.max(F.struct("version", "content")).alias("best"))
            .select("record_key", "best.version", "best.content", "part")
        )
        # new files are written beside those that are read, and take their place when all are there
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/latest")

    def changes(self, numbers: dict[int, int]) -> DataFrame:
        """(run_seq, record_key) of the runs given as number to run_seq."""
        done = [int(name.removeprefix("run-")) for name in complete_folders(self.spark, f"{self.path}/changes")]
        out = self.spark.createDataFrame([], "run_seq int, record_key string")
        paths = [self._changes(n) for n in done if n in numbers]
        if not paths:
            return out
        rows = self.spark.read.schema(CHANGES).option("basePath", f"{self.path}/changes").parquet(*paths)
        name = F.regexp_extract("_metadata.file_path", r"/run-(\d+)/", 1).cast("int")
        run = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
        return rows.select(run[name].alias("run_seq"), "record_key")


def catch_up(spark: SparkSession, path: str, staged: DataFrame, order: list[int]) -> DataFrame:
    """Apply all runs in ``order`` that the store at ``path`` has not had, one by one, and return the
    changes of all of them as (run_seq, record_key): a record stands there for a run if it is new in
    that run, or if its current content (that of its latest version so far) is not what it was at
    the run before. Empty ``staged`` gives no change."""
    store = ChangeStore(spark, path)
    each = staged.groupBy("part", "run_seq").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("record_key", "version", "content", "run_seq").cast("decimal(38,0)")).alias("hash_sum")
    ).limit(MOST_SUMS + 1).collect()
    if len(each) > MOST_SUMS:
        raise ValueError(f"more than {MOST_SUMS} partitions and runs at once; catch up in parts")
    numbers = {place: run for place, run in enumerate(order, 1)}
    sums: dict[str, tuple[int, int]] = {}
    done, _ = store.fingerprints()
    for number, run in numbers.items():
        expected = dict(sums)
        for r in each:
            if r["run_seq"] == run:
                n, h = sums.get(r["part"], (0, 0))
                sums[r["part"]] = (n + r["n"], h + int(r["hash_sum"]))
        if number > done:
            store.apply(number, staged, order[:number], expected, sums)
    return store.changes(numbers)
