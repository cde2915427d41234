"""Manifests and blobs in an object store, through Spark's own file systems."""

from __future__ import annotations

import gzip
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import blob_key
from graphloom.operators.state import absent
from graphloom.schemas import MANIFEST
from graphloom.sources import objects

#: Names of manifests: those of other writers, and those that Spark gives to JSON lines.
MANIFEST_FILES = "*.{jsonl,json}.gz"


def list_manifests(spark: SparkSession, root: str) -> DataFrame:
    """(manifest_key) of all manifests in ``raw/`` below a root, which may be any file system URI.
    Only names are listed, no file is read. No manifest is an empty table."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/raw")
    system = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(base):
        return spark.createDataFrame([], "manifest_key string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", MANIFEST_FILES).load(str(base.toString()))
    return files.select(F.regexp_extract("path", r"(raw/.*)$", 1).alias("manifest_key"))


def read_manifests(spark: SparkSession, root: str, keys: list[str] | None = None) -> DataFrame:
    """Lines of manifests with ``manifest_key`` and ``line`` (their order in it). A missing field is
    null, a broken line is skipped; nested source_meta keeps its text."""
    paths = [f"{root.rstrip('/')}/{k}" for k in keys] if keys is not None else [f"{root.rstrip('/')}/raw"]
    if not paths:
        return spark.createDataFrame([], MANIFEST).select("*", F.lit("").alias("manifest_key"), F.lit(0).cast("long").alias("line"))
    reader = spark.read.schema(MANIFEST).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", MANIFEST_FILES)
    lines = reader.json(paths)
    return lines.select("*", F.regexp_extract("_metadata.file_path", r"(raw/.*)$", 1).alias("manifest_key"), F.monotonically_increasing_id().alias("line"))


def write_manifest(records: DataFrame, path: str, per_file: int = 25) -> None:
    """Append gzip JSON lines, at most ``per_file`` a file; an empty table writes no line."""
    records.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", per_file).json(path)


def blob_rows(payloads: DataFrame, index: DataFrame, keep_prefix_days: int | None = None, now=None) -> DataFrame:
    """New rows for the blob table from (sha256, kind, bytes): each digest and kind class once, those
    already held left out. Prefixes get an expiry, graphs are kept. Null digests are left out."""
    kind_class = F.when(F.col("kind") == "prefix", "prefix").otherwise("graph")
    digests = payloads.filter(F.col("sha256").isNotNull()).select("sha256", kind_class.alias("kind_class"), "kind", "bytes")
    fresh = absent(digests, index, ["sha256", "kind_class"])
    until = (now + F.make_interval(days=F.lit(keep_prefix_days))) if keep_prefix_days is not None and now is not None else F.lit(None).cast("timestamp")
    return fresh.withColumn("bucket_key", blob_key("sha256", "kind")).withColumn("expires_at", F.when(F.col("kind") == "prefix", until))


def _key(digest: str, kind: str) -> str:
    """As :func:`blob_key`."""
    return f"blob/{digest[:2]}/{digest}.{'bin' if kind == 'prefix' else 'json'}.gz"


def write_blobs(payloads: DataFrame, root: str) -> DataFrame:
    """Store (content, kind) as objects below a root, under their digests; (sha256, kind, bytes) of each
    row comes back without its content. An object that is there is left, so repeats and tasks run
    twice change nothing. Nothing is stored before the result is read; null contents give no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = objects.open_root(root)
        for batch in batches:
            rows = []
            for content, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = hashlib.sha256(content).hexdigest()
                objects.put(system, f"{base}/{_key(digest, kind)}", gzip.compress(content, mtime=0))
                rows.append((digest, kind, len(content)))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()), strict=True)], names=["sha256", "kind", "bytes"])

    return payloads.filter(F.col("content").isNotNull()).select("content", "kind").mapInArrow(run, "sha256 string, kind string, bytes int")


def drop_blobs(rows: DataFrame, root: str) -> int:
    """Delete the objects of (sha256, kind); those that are gone already count too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = objects.open_root(root)
        for batch in batches:
            for digest, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                objects.drop(system, f"{base}/{_key(digest, kind)}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return rows.select("sha256", "kind").mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]


def _document(packed: bytes | None) -> str | None:
    try:
        text = gzip.decompress(packed).decode("utf-8")
        json.loads(text)
    except (OSError, EOFError, ValueError, TypeError, RecursionError):
        return None
    return text


def read_blobs(wanted: DataFrame, root: str) -> DataFrame:
    """(sha256, document): the JSON blobs of the digests wanted and no others; null for what is missing
    or cannot be read. Each task fetches those of its rows by their names, nothing is listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = objects.open_root(root)
        for batch in batches:
            texts = [_document(objects.get(system, f"{base}/{_key(digest, 'workflow')}")) for digest in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["sha256", "document"])

    return wanted.filter(F.col("sha256").isNotNull()).select("sha256").mapInArrow(run, "sha256 string, document string")
