"""From manifests and blobs to the tables of the lake, in re-runnable batches.

A document is derived once however many records carry it. A record whose document is missing,
unreadable or of no known shape keeps its raw row. Tables are appended first and the manifest
is marked as consumed last; running it again appends rows that latest-wins folds away.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.functions.graph import derive
from graphloom.functions.text import seconds_text
from graphloom.operators import attribution
from graphloom.operators.skew import lookup
from graphloom.operators.state import drifted, latest
from graphloom.schemas import DERIVED, INGEST_VERSION, TABLES
from graphloom.sources import manifests as store
from graphloom.sources.shared import exists, materialize, remove

STAMP = ["ingest_version", "manifest_key", "line"]


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def derive_documents(documents: DataFrame, declared: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows of DERIVED for (sha256, document text); a null document gives an error row. Each
    document is parsed once: make them distinct first."""
    names = dict(declared or {})
    schema = _arrow_schema(DERIVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sha, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    document = json.loads(text) if text is not None else None
                except (ValueError, RecursionError):
                    document = None
                rows.append({"sha256": sha} | derive(document, names))
            yield pa.RecordBatch.from_pylist(rows, schema)

    return documents.select("sha256", "document").mapInArrow(run, DERIVED)


def payload_rows(lines: DataFrame) -> DataFrame:
    """Lines that carry a graph."""
    return lines.filter(F.col("payload_kind").isin("workflow", "prompt") & (F.coalesce("payload_sha256", F.lit("")) != ""))


def carried_rows(lines: DataFrame) -> DataFrame:
    """Lines once for each document in their ``documents``, which then stands in payload_sha256;
    as they are where that is empty or not given."""
    if "documents" not in lines.columns:
        return lines
    own = F.when(F.size("documents") > 0, F.col("documents")).otherwise(F.array("payload_sha256"))
    return lines.withColumn("payload_sha256", F.explode(own)).drop("documents")


def _weighted(right: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """``right``, unique by key, with ``_n``, how many rows of ``left`` have it; stored. One document may be
    what a third of all lines carry."""
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return materialize(right.join(counts, key), "weighted")


def raw_rows(lines: DataFrame, derived: DataFrame) -> DataFrame:
    """Rows of raw_artifacts, one a line, with defaults in place of nulls and the workflow of the
    payload, '' if there is none; of several documents of a line the first."""
    if "documents" in lines.columns:
        lines = lines.withColumns({"payload_ref": F.col("payload_sha256"), "payload_sha256": F.coalesce(F.try_element_at("documents", F.lit(1)), "payload_sha256")})
    else:
        lines = lines.withColumn("payload_ref", F.col("payload_sha256"))
    at = lambda c: F.try_to_timestamp(seconds_text(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    lines = lines.withColumn("_sha", F.when(F.col("payload_kind").isin("workflow", "prompt"), F.col("payload_sha256")))
    known = derived.filter("format <> 'unknown'").select(F.col("sha256").alias("_sha"), F.col("workflow_id").alias("_workflow"))
    joined = lookup(lines, _weighted(known, lines, "_sha"), ["_sha"], "_n", ["capture_id", "line"], "left")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    number = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    return joined.select(
        "capture_id", at("crawled_at").alias("crawled_at"), text("crawler_version"), "source", "channel", "source_artifact_id",
        *[text(c) for c in ("parent_url", "fetch_url", "author", "author_id", "title", "description")],
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), at("published_at").alias("published_at"),
        F.coalesce("stats", F.create_map().cast("map<string,bigint>")).alias("stats"), F.coalesce("source_meta", F.lit("{}")).alias("source_meta"),
        number("http_status", "int"), text("content_type"), text("container"), "total_size", number("bytes_fetched", "long"), "needed_bytes",
        F.coalesce("windows", F.array().cast("array<bigint>")).alias("windows"), F.coalesce("from_tail", F.lit(False)).alias("from_tail"),
        F.coalesce("payload_kind", F.lit("none")).alias("payload_kind"), F.coalesce("payload_ref", F.lit("")).alias("payload_ref"),
        number("payload_bytes", "long"), F.coalesce("_workflow", F.lit("")).alias("workflow_id"),
        F.coalesce(F.date_format(at("crawled_at"), "yyyy-MM"), F.lit("")).alias("yyyymm"),
        F.lit(INGEST_VERSION).cast("long").alias("ingest_version"), "manifest_key", "line",
    )


def derived_tables(lines: DataFrame, derived: DataFrame, core: DataFrame, named: DataFrame, repos: DataFrame) -> dict[str, DataFrame]:
    """The derived tables of a batch. ``derived`` should be stored: four tables read it."""
    good = derived.filter("format <> 'unknown'")
    at = lambda c: F.try_to_timestamp(seconds_text(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    sightings = payload_rows(lines).select(
        F.col("payload_sha256").alias("sha256"), "source", "source_artifact_id", "channel", "payload_kind", F.coalesce("author", F.lit("")).alias("author"),
        at("published_at").alias("published_at"), F.coalesce(at("published_at"), at("crawled_at")).alias("first_seen"), "manifest_key", "line",
    )
    placed = lookup(sightings, _weighted(good.select("sha256", "workflow_id"), sightings, "sha256"), ["sha256"], "_n", ["source_artifact_id", "line"])
    # the first record of a workflow, by manifest and place in it
    first = placed.groupBy("workflow_id").agg(
        F.min_by(F.struct(F.col("source").alias("first_source"), "first_seen", "manifest_key", "line"), F.struct("manifest_key", "line")).alias("f")
    ).select("workflow_id", "f.*", F.lit(INGEST_VERSION).cast("long").alias("ingest_version"))
    once = latest(good.drop("error"), ["workflow_id"], ["sha256"])
    nodes = once.select("workflow_id", F.explode("nodes").alias("n")).select("workflow_id", "n.*")
    attributed = attribution.attribute(nodes, core, named, repos, ["workflow_id", "node_id"])
    summary = attribution.workflow_packs(attributed)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("stamped_nodes", "cnr_nodes", "aux_nodes", "muted_or_bypassed", "hidden_prompt_nodes", "pack_set_size")}
    workflows = once.join(summary, "workflow_id", "left").join(first, "workflow_id").withColumns(
        zero | {"pack_set": F.coalesce("pack_set", F.array().cast("array<string>"))}
    )
    stamp = first.select("workflow_id", *STAMP)
    columns = {name: [f.name for f in StructType.fromDDL(spec.schema).fields] for name, spec in TABLES.items()}
    bindings = once.select("workflow_id", F.explode("bindings").alias("b")).select("workflow_id", "b.*")
    links = placed.withColumn("ingest_version", F.lit(INGEST_VERSION).cast("long"))
    made = {
        "derived_workflows": workflows, "derived_workflow_nodes": attributed.join(stamp, "workflow_id"),
        "derived_workflow_bindings": bindings.join(stamp, "workflow_id"), "derived_artifact_workflows": links,
    }
    return {name: df.select(*columns[name]) for name, df in made.items()}


def failures(derived: DataFrame, lines: DataFrame) -> DataFrame:
    """(source_artifact_id, payload_sha256, error) of payloads that could not be derived."""
    bad = derived.filter("format = 'unknown'").select(F.col("sha256").alias("payload_sha256"), "error")
    return payload_rows(lines).join(bad, "payload_sha256").select("source_artifact_id", "payload_sha256", "error")


class Lake:
    """Tables of the lake below one path, with the set of consumed manifests."""

    def __init__(self, spark: SparkSession, path: str, core: DataFrame, pack_nodes: DataFrame, packs: DataFrame, declared: dict | None = None):
        self.spark, self.path, self.declared = spark, path.rstrip("/"), declared
        self.repos = materialize(attribution.repo_packs(packs), "repos")
        self.core = materialize(attribution.core_flags(core), "core")
        self.named = materialize(attribution.class_packs(pack_nodes, self.repos), "named")

    def _at(self, name: str) -> str:
        return f"{self.path}/tables/{name}/v{TABLES[name].version}"

    def physical(self, name: str) -> DataFrame:
        """All rows of a table, older versions of a key included."""
        schema = StructType.fromDDL(TABLES[name].schema)
        if not exists(self.spark, self._at(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._at(name))

    def table(self, name: str) -> DataFrame:
        """The logical rows: the latest of each key."""
        spec = TABLES[name]
        return latest(self.physical(name), list(spec.key), list(spec.latest))

    def by_class(self) -> DataFrame:
        """The copy of the node table that is sorted by class_type, for filters on it."""
        at = f"{self._at('derived_workflow_nodes')}-by-class"
        return self.spark.read.parquet(at) if exists(self.spark, at) else self.table("derived_workflow_nodes")

    def compact(self, name: str) -> int:
        """Write a table anew with its logical rows only; nodes also sorted by class. Returns how
        many rows went."""
        spec, at = TABLES[name], self._at(name)
        before = self.physical(name).count()
        rows = materialize(self.table(name), f"compact-{name}")
        writer = rows.repartitionByRange(*spec.sort_by).sortWithinPartitions(*spec.sort_by).write.mode("overwrite")
        (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).parquet(at)
        if name == "derived_workflow_nodes":
            rows.repartitionByRange("class_type").sortWithinPartitions("class_type").write.mode("overwrite").parquet(f"{at}-by-class")
        return before - rows.count()

    def consumed(self) -> DataFrame:
        """Manifests whose rows are in every table of its present version."""
        at = f"{self.path}/consumed"
        schema = "manifest_key string, versions string"
        if not exists(self.spark, at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(at).filter(F.col("versions") == self._versions()).select("manifest_key", "versions")

    @staticmethod
    def _versions() -> str:
        return ",".join(f"{n}={s.version}" for n, s in TABLES.items())

    def reset(self) -> None:
        """Forget what was consumed, so that the next run reads everything again."""
        if exists(self.spark, f"{self.path}/consumed"):
            remove(self.spark, f"{self.path}/consumed")

    def check(self) -> dict[str, list[str]]:
        """Differences between stored tables and their declared schemas, by table."""
        found = {}
        for name, spec in TABLES.items():
            if exists(self.spark, self._at(name)):
                found[name] = drifted(self.spark.read.parquet(self._at(name)), spec.schema)
        return {k: v for k, v in found.items() if v}

    def load(self, lines: DataFrame, documents: DataFrame | str) -> dict:
        """Append one batch of manifest lines to all tables, then mark its manifests. ``documents``:
        (sha256, document), or the root below which they lie as blobs, of which those wanted are read.
        Lines may have ``documents``, the keys of the documents that each carries; else it is
        payload_sha256. ``skipped`` counts all payloads without a graph; reasons and examples are the
        first ones."""
        lines = materialize(lines, "lines")
        carried = carried_rows(lines)
        wanted = payload_rows(carried).select(F.col("payload_sha256").alias("sha256")).distinct()
        held = store.read_blobs(wanted, documents) if isinstance(documents, str) else wanted.join(documents, "sha256", "left")
        derived = materialize(derive_documents(held, self.declared), "derived")
        tables = {"raw_artifacts": raw_rows(lines, derived)} | derived_tables(carried, derived, self.core, self.named, self.repos)
        rows = {}
        for name, df in tables.items():
            spec = TABLES[name]
            counted = Observation()
            sized = df.observe(counted, F.count(F.lit(1)).alias("n"))
            writer = (sized.sortWithinPartitions(*spec.partition_by, *spec.sort_by) if spec.sort_by else sized).write.mode("append")
            (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).parquet(self._at(name))
            rows[name] = counted.get["n"]
        keys = lines.select("manifest_key").distinct().withColumn("versions", F.lit(self._versions()))
        keys.coalesce(1).write.mode("append").parquet(f"{self.path}/consumed")
        bad = materialize(failures(derived, carried), "failures")
        reasons = bad.groupBy(F.split("error", ":")[0].alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy("reason").limit(100).collect()
        return {
            "records": rows["raw_artifacts"], "rows": rows, "skipped": bad.count(), "skipped_reasons": [r["reason"] for r in reasons],
            "skipped_examples": [tuple(r) for r in bad.orderBy("source_artifact_id").limit(10).collect()],
        }

    def repair(self) -> dict[str, list[str]]:
        """Bring stored tables to their declared schemas: columns that are missing are null, those not
        declared go, others are cast (null where that fails). What was consumed is then read again,
        so that repaired columns get their values. Returns what differed, by table."""
        found = self.check()
        for name in found:
            declared = StructType.fromDDL(TABLES[name].schema).fields
            stored = self.spark.read.parquet(self._at(name))
            columns = [
                (F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in stored.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in declared
            ]
            rows, spec = materialize(stored.select(*columns), f"repair-{name}"), TABLES[name]
            writer = rows.write.mode("overwrite")
            (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).parquet(self._at(name))
        if found:
            self.reset()
        return found

    def ingest(self, root: str, limit: int | None = None, documents: DataFrame | str | None = None, per_load: int = 500) -> dict:
        """Load the manifests below ``root`` that are not consumed, ``per_load`` at a time and each time
        marked; ``limit`` takes the first of them by name and leaves the rest for the next run.
        ``documents`` (sha256, document) are taken in place of the blobs below ``root``."""
        new = materialize(store.list_manifests(self.spark, root).join(self.consumed(), "manifest_key", "left_anti"), "new")
        found = new.count()
        total = {"manifests": 0, "remaining": found, "records": 0, "rows": {}, "skipped": 0, "skipped_reasons": [], "skipped_examples": []}
        ordered = new.orderBy("manifest_key")
        names = (r["manifest_key"] for r in (ordered.limit(limit) if limit else ordered).toLocalIterator())
        while keys := list(itertools.islice(names, per_load)):
            part = self.load(store.read_manifests(self.spark, root, keys), root if documents is None else documents)
            total["manifests"] += len(keys)
            total["remaining"] -= len(keys)
            for what in ("records", "skipped"):
                total[what] += part[what]
            total["rows"] = {name: n + total["rows"].get(name, 0) for name, n in part["rows"].items()}
            total["skipped_reasons"] = sorted({*total["skipped_reasons"], *part["skipped_reasons"]})[:100]
            total["skipped_examples"] = (total["skipped_examples"] + part["skipped_examples"])[:10]
        return total
