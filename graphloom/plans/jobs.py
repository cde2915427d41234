"""Queries that run whole jobs of the lake: loading, streaming, containers, recorded pages."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from graphloom.functions.containers import parse
from graphloom.functions.jsontext import decode_object
from graphloom.functions.ranges import capture_file
from graphloom.functions.text import normal_hash
from graphloom.operators import listing
from graphloom.operators.shred import graphs
from graphloom.operators.skew import small_join
from graphloom.plans import samples
from graphloom.plans.ingest import Lake, payload_rows
from graphloom.plans.tables import table
from graphloom.sources.pages import RecordedPages, write_pages
from graphloom.sources.shared import materialize, scratch_path
from graphloom.streaming.health import health_stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


# --- containers ---------------------------------------------------------------------------


@query("""
SELECT workflow_id, batch_no, coalesce(workflow_id, '') AS found_class, node_count AS found_nodes, k <> 'isobmff' AS in_head,
  CASE WHEN k LIKE 'png%' THEN 'png' ELSE k END AS container
FROM (SELECT workflow_id, batch_no, node_count, ['png', 'png-z', 'png-i', 'webp', 'jpeg', 'isobmff'][node_count % 6 + 1] AS k FROM derived_workflows WHERE node_count IS NOT NULL)""")
def container_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph texts out of files of all kinds (B1 to B11) and the byte ranges that takes (2.12): class and
    number of nodes as they stand in the document found by reading ranges. Stand-in: a file built for
    each workflow row, of a kind by its node count."""
    rows = table(spark, sf_dir, "derived_workflows").filter("node_count IS NOT NULL").select("workflow_id", "batch_no", "node_count")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for workflow, number, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                document = json.dumps({"nodes": [{"id": n, "type": workflow or ""} for n in range(count)]})
                content = samples.build_file(samples.KINDS[count % 6], document)
                part, whole = capture_file(content), parse(content)
                found = json.loads(part.workflow)["nodes"] if part.workflow == whole.documents.get("workflow") else []
                out.append((workflow, number, found[0]["type"] if found else "", len(found), not part.from_tail, whole.container))
            names = ["workflow_id", "batch_no", "found_class", "found_nodes", "in_head", "container"]
            types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return rows.mapInArrow(run, "workflow_id string, batch_no int, found_class string, found_nodes bigint, in_head boolean, container string")


# --- loading ------------------------------------------------------------------------------


def graph_texts(meta: str | None) -> dict[str, str]:
    """The text of each graph in a source_meta by its digest."""
    held = decode_object(meta)
    found = [json.dumps(graph) for _, _, graph in graphs(held)] if held is not None else []
    return {hashlib.sha256(text.encode()).hexdigest(): text for text in found}


def _own_graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = zip(*(batch.column(c).to_pylist() for c in ("payload_kind", "payload_sha256", "source_meta")), strict=True)
        own = [sorted(graph_texts(meta)) if kind in ("workflow", "prompt") and sha else [] for kind, sha, meta in wanted]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.string()))], names=[*batch.schema.names, "own"])


def _graph_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [pair for meta in batch.column(0).to_pylist() for pair in graph_texts(meta).items()]
        columns = zip(*out, strict=True) if out else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["sha256", "document"])


def captured_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_artifacts as manifest lines; the capture id and time stand for the place in a file."""
    order = F.xxhash64("capture_id", "crawled_at", "payload_sha256", "title")
    return carry_graphs(table(spark, sf_dir, "raw_artifacts").drop("workflow_id").withColumn("line", order))


def carry_graphs(lines: DataFrame) -> DataFrame:
    """Lines with ``documents``, the digests of the graphs that each one carries. Stand-in for the
    blob of its payload: all graphs in its own source_meta; if there is none, the least graph
    in any capture of the payload. Empty if no capture of the payload has one."""
    own = StructType([*lines.schema.fields, StructField("own", ArrayType(StringType()))])
    keyed = materialize(lines.mapInArrow(_own_graphs, own).withColumn("payload", normal_hash("payload_sha256")), "keyed")
    carriers = payload_rows(keyed)
    spare = materialize(carriers.filter("size(own) > 0").groupBy("payload").agg(F.min(F.array_min("own")).alias("spare")).filter("payload IS NOT NULL"), "spare")
    lacks = F.col("payload_kind").isin("workflow", "prompt") & (F.coalesce("payload_sha256", F.lit("")) != "") & (F.size("own") == 0)
    other = F.when(lacks & F.col("spare").isNotNull(), F.array("spare")).otherwise(F.col("own"))
    return small_join(keyed, spare, ["payload"], ["capture_id", "crawled_at"]).select(*lines.columns, other.alias("documents"))


def captured_documents(lines: DataFrame) -> DataFrame:
    """(sha256, document): every graph in the source_meta of any line that carries a payload, once."""
    metas = payload_rows(lines).filter("source_meta IS NOT NULL").select("source_meta")
    return metas.mapInArrow(_graph_texts, "sha256 string, document string").dropDuplicates(["sha256"])


def make_lake(spark: SparkSession, sf_dir: str, path: str) -> Lake:
    return Lake(spark, path, table(spark, sf_dir, "core_classes"), table(spark, sf_dir, "pack_nodes"), table(spark, sf_dir, "packs"))


@query("""
SELECT source, count(*) AS captures FROM (
  SELECT DISTINCT source, source_artifact_id, channel, capture_id,
    CASE WHEN length(replace(replace(crawled_at, 'T', ' '), 'Z', '')) >= 19 THEN left(replace(replace(crawled_at, 'T', ' '), 'Z', ''), 19) END AS seconds
  FROM raw_artifacts) GROUP BY 1""")
def lake_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load (3.1, P7 to P12, K1 to K7, A12): all captures go into all tables; the result
    is the logical rows of the raw table by source."""
    lake = make_lake(spark, sf_dir, scratch_path(spark, "lake"))
    lines = materialize(captured_lines(spark, sf_dir), "lines")
    lake.load(lines, captured_documents(lines))
    return lake.table("raw_artifacts").groupBy("source").agg(F.count(F.lit(1)).alias("captures"))


@query()
def lake_workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workflow table after a whole load, loaded twice: the second changes no logical row.
    Stand-in: the graphs in source_meta as the documents of the payloads, see :func:`carry_graphs`."""
    lake = make_lake(spark, sf_dir, scratch_path(spark, "lake"))
    lines = materialize(captured_lines(spark, sf_dir), "lines")
    documents = materialize(captured_documents(lines), "documents")
    for _ in range(2):
        lake.load(lines, documents)
    return lake.table("derived_workflows")


@query("""
WITH log AS (SELECT user_id, ts, event_id, event_type = 'error' AS bad, event_type IN ('click', 'purchase') AS good FROM events),
runs AS (SELECT *, sum(good::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM log WHERE bad OR good)
SELECT user_id::VARCHAR AS host, count(*) AS refusals_seen, max(streak) AS longest, bool_or(streak >= 3) AS latched
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS streak FROM runs WHERE bad) GROUP BY 1""")
def health_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latches kept as streaming state (R6, R7). Stand-in: events as requests, errors as 403,
    clicks and purchases as 200, the rest as 404."""
    status = F.when(F.col("event_type") == "error", 403).when(F.col("event_type").isin("click", "purchase"), 200).otherwise(404)
    source = scratch_path(spark, "requests")
    table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("host"), F.col("ts").cast("timestamp").alias("ts"), status.alias("status")).write.parquet(source)
    out, checkpoint = scratch_path(spark, "health"), scratch_path(spark, "checkpoint")
    stream = spark.readStream.schema("host string, ts timestamp, status int").option("maxFileAge", "36500d").parquet(source)
    run = health_stream(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.read.parquet(out).filter("status = 403")
    return rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("refusals_seen"), F.max("refusals").cast("long").alias("longest"), F.max("latched").alias("latched")
    )


@query("""
SELECT 'user-' || s AS stream, CAST(p AS INT) AS page, CAST(k AS INT) AS position, (1000 * s + 10 * p + k)::VARCHAR AS artifact_id, (7 * p + k // 2)::VARCHAR AS post_id,
  'u' || k AS author, '2026-0' || (p + 1) || '-1' || k || 'T00:00:00Z' AS published_at, k % 2 = 1 AS marked, k % 3 = 0 AS has_meta,
  CASE WHEN k = 0 THEN 0 ELSE CAST(floor(2.9 * k) AS BIGINT) END AS likes, k + 0 AS author_id
FROM range(3) a(s), range(3) b(p), range(5) c(k)""")
def recorded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages through the Python data source (S8 to S10, S14, P1, P17, F21). A fixture of three
    streams is recorded first, in the shared folder: the source reads pages, not test tables."""
    root = scratch_path(spark, "pages")
    for stream in range(3):
        pages = [
            [
                {
                    "id": 1000 * stream + 10 * page + k, "postId": 7 * page + k // 2, "userId": k, "user": {"username": f"u{k}"},
                    "publishedAt": ["Date", f"2026-0{page + 1}-1{k}T00:00:00Z"], "toolIds": [86] if k % 2 else [], "hasMeta": k % 3 == 0,
                    "stats": {"likes": 2.9 * k, "note": "x"}, "url": f"id-{k}", "type": "image",
                }
                for k in range(5)
            ]
            for page in range(3)
        ]
        write_pages(root, f"user-{stream}", pages)
    spark.dataSource.register(RecordedPages)
    items = spark.read.format("recorded_pages").option("path", root).load()
    return items.select(
        "stream", "page", "position", "artifact_id", "post_id", "author", "published_at", listing.wanted(F.col("tool_ids"), F.col("has_meta"), "tagged").alias("marked"),
        "has_meta", F.col("stats")["likes"].alias("likes"), F.col("author_id").cast("bigint").alias("author_id"),
    )
