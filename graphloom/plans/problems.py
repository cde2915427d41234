"""Queries of the general data problems: drifting schemas, nested records, changed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import normal_hash, seconds_text, squeeze, strip
from graphloom.operators import drift, incremental, shred
from graphloom.plans.tables import table
from graphloom.sources.shared import materialize, scratch_path


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(drift.flatten(table(spark, sf_dir, "raw_artifacts")), "flat")


VERSION_COLUMNS = ["frontend_version", "graph_version"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of source_meta between neighbouring months of a source, and of the notation
    of the two version columns between neighbouring batches."""
    versions = drift.reshaped(
        table(spark, sf_dir, "derived_workflows"), "derived_workflows", "batch_no", VERSION_COLUMNS
    )
    return drift.changes(_flat(spark, sf_dir)).unionByName(versions)


def p2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema version and fingerprint of each source and month."""
    flat = drift.flatten(table(spark, sf_dir, "raw_artifacts"))
    return drift.versions(materialize(drift.field_types(flat), "types"))


def p2_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_meta of all readable records under the newest names and types of their source, and
    the version columns of derived_workflows in one notation (month: batch, capture_id: workflow_id)."""
    raw = table(spark, sf_dir, "raw_artifacts")
    flat = _flat(spark, sf_dir)
    types = materialize(drift.field_types(flat), "types")
    versions = drift.unify_versions(table(spark, sf_dir, "derived_workflows"), "derived_workflows", "batch_no", "workflow_id", VERSION_COLUMNS)
    return drift.unify(raw, drift.MigrationPlan(drift.changes(flat), types)).unionByName(versions)


#: Fields of readable records by row, and their types by month.
P2_FLAT = r"""
WITH once AS (
  SELECT source, regexp_extract(manifest_key, '/(\d{4}-\d{2})/', 1) AS month, capture_id, coalesce(workflow_id, '') AS workflow_id,
    CASE WHEN json_valid(source_meta) THEN CASE WHEN json_type(source_meta) = 'VARCHAR' THEN json_extract_string(source_meta, '$') ELSE source_meta END END AS meta
  FROM raw_artifacts WHERE source IS NOT NULL
), objects AS (
  SELECT row_number() OVER () AS r, source, month, capture_id, workflow_id, meta FROM once WHERE month <> '' AND json_valid(meta) AND json_type(meta) = 'OBJECT'
), flat AS (
  SELECT r, source, month, capture_id, workflow_id, replace(substr(t.fullkey, 3), '"', '') AS field,
    CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS type,
    CASE WHEN t.type = 'VARCHAR' THEN 's' || (t.atom->>'$') WHEN t.type <> 'ARRAY' THEN coalesce(try_cast(t.atom AS DOUBLE)::VARCHAR, t.atom::VARCHAR) END AS value
  FROM objects, json_tree(objects.meta) AS t WHERE t.type NOT IN ('OBJECT', 'NULL') AND NOT contains(t.fullkey, '[')
), types AS (SELECT source, month, field, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM flat GROUP BY 1, 2, 3

)"""
P2_SQL = P2_FLAT + r""", steps AS (
  SELECT source, month AS step, before FROM (SELECT source, month, lag(month) OVER (PARTITION BY source ORDER BY month) AS before FROM (SELECT DISTINCT source, month FROM types)) WHERE before IS NOT NULL
), old AS (SELECT s.source, s.step, s.before, t.field, t.types FROM steps s JOIN types t ON t.source = s.source AND t.month = s.before
), new AS (SELECT s.source, s.step, s.before, t.field, t.types FROM steps s JOIN types t ON t.source = s.source AND t.month = s.step
), gone AS (SELECT o.* FROM old o ANTI JOIN new n ON n.source = o.source AND n.step = o.step AND n.field = o.field
), come AS (SELECT n.* FROM new n ANTI JOIN old o ON n.source = o.source AND n.step = o.step AND n.field = o.field
), a AS (SELECT g.source, g.step, g.field, f.capture_id, f.workflow_id, f.value FROM gone g JOIN flat f ON f.source = g.source AND f.month = g.before AND f.field = g.field WHERE f.value IS NOT NULL
), b AS (SELECT c.source, c.step, c.field, f.capture_id, f.workflow_id, f.value FROM come c JOIN flat f ON f.source = c.source AND f.month = c.step AND f.field = c.field WHERE f.value IS NOT NULL
), renamed AS (
  SELECT a.source, a.step, a.field AS old_field, b.field AS new_field FROM a JOIN b ON a.source = b.source AND a.step = b.step AND a.capture_id = b.capture_id AND a.workflow_id = b.workflow_id
  GROUP BY 1, 2, 3, 4 HAVING bool_and(a.value = b.value)
), shapes AS (
  SELECT batch_no, field, string_agg(DISTINCT shape, ',' ORDER BY shape) AS shapes FROM (
    SELECT batch_no, 'frontend_version' AS field, nullif(regexp_replace(regexp_replace(frontend_version, '^\s+|\s+$', '', 'g'), '[0-9]+', '9', 'g'), '') AS shape FROM derived_workflows
    UNION ALL SELECT batch_no, 'graph_version', nullif(regexp_replace(regexp_replace(graph_version, '^\s+|\s+$', '', 'g'), '[0-9]+', '9', 'g'), '') FROM derived_workflows
  ) WHERE batch_no IS NOT NULL GROUP BY 1, 2
), moved AS (SELECT *, lag(shapes) OVER w AS before, row_number() OVER w AS n FROM shapes WINDOW w AS (PARTITION BY field ORDER BY batch_no))
SELECT source, step, old_field, new_field, 'renamed' AS drift FROM renamed
UNION ALL SELECT source, step, field, '', 'removed' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM renamed r WHERE r.source = g.source AND r.step = g.step AND r.old_field = g.field)
UNION ALL SELECT source, step, '', field, 'added' FROM come g WHERE NOT EXISTS (SELECT 1 FROM renamed r WHERE r.source = g.source AND r.step = g.step AND r.new_field = g.field)
UNION ALL SELECT o.source, o.step, o.field, o.field, 'retyped' FROM old o JOIN new n ON n.source = o.source AND n.step = o.step AND n.field = o.field WHERE n.types <> o.types
UNION ALL SELECT 'derived_workflows', lpad(batch_no::VARCHAR, 2, '0'), field, field, 'reshaped' FROM moved WHERE n > 1 AND coalesce(before, '') <> coalesce(shapes, '')"""
P2_VERSIONS_SQL = P2_FLAT + r"""
, prints AS (
  SELECT source, month, count(*) AS n_fields,
    md5('[' || string_agg('{"field":"' || field || '","types":["' || replace(types, ',', '","') || '"]}', ',' ORDER BY field) || ']') AS fingerprint
  FROM types GROUP BY 1, 2
), moved AS (SELECT *, CASE WHEN fingerprint IS DISTINCT FROM lag(fingerprint) OVER w THEN 1 ELSE 0 END AS moved FROM prints WINDOW w AS (PARTITION BY source ORDER BY month))
SELECT source, month, n_fields, fingerprint, CAST(sum(moved) OVER (PARTITION BY source ORDER BY month) AS INT) AS version FROM moved
"""

#: What the node tables give to p3_found, and where a stamp stands if its element has its own table.
NODE_FIELDS = {"node": ["id", "type", "properties.cnr_id"], "api_node": ["class_type"]}
STAMPS = "node.properties"


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node in any readable source_meta, with the subgraph it stands in and its parent: the rows
    of the two node tables of the measured layout. A stamp is inlined in its node, unless the
    layout of these records gives stamps a table; then it is joined by its foreign key."""
    raw = table(spark, sf_dir, "raw_artifacts")
    holders = shred.measured_layout(raw)
    apart = holders.get(STAMPS) == STAMPS
    keys = ["table_name", "capture_id", "entry_key", "graph", "parent_subgraph_id", "subgraph_id"]
    if apart:
        rows = materialize(shred.shred(raw, holders, NODE_FIELDS | {STAMPS: ["cnr_id"]}, (*keys, "row_id", "parent_id")), "nodes")
        stamps = rows.filter(F.col("table_name") == STAMPS).select(F.col("capture_id").alias("_c"), F.col("parent_id").alias("_p"), F.col("fields")["cnr_id"].alias("cnr"))
        rows = rows.join(stamps.distinct(), F.col("capture_id").eqNullSafe(F.col("_c")) & (F.col("row_id") == F.col("_p")), "left")
    else:
        rows = shred.shred(raw, holders, NODE_FIELDS, tuple(keys)).withColumn("cnr", F.col("fields")["properties.cnr_id"])
    own = lambda name: F.coalesce(F.col("fields")[name], F.lit(""))
    entry = F.col("table_name") == "api_node"
    return rows.filter(F.col("table_name").isin(*NODE_FIELDS)).select(
        "capture_id", "graph", "parent_subgraph_id", "subgraph_id", F.when(entry, F.col("entry_key")).otherwise(own("id")).alias("node_id"),
        F.when(entry, own("class_type")).otherwise(own("type")).alias("class_type"), F.coalesce("cnr", F.lit("")).alias("cnr_id"),
    ).distinct()


def p3_subgraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subgraph table: key (graph_id, subgraph_id), foreign keys to capture, graph, parent."""
    raw = table(spark, sf_dir, "raw_artifacts")
    keys = ("table_name", "capture_id", "graph_id", "parent_subgraph_id", "subgraph_id")
    return shred.table(shred.shred(raw, shred.measured_layout(raw), {"subgraph": []}, keys), "subgraph", [])


def p3_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which element types have a table of their own and which are inlined where."""
    return shred.describe(table(spark, sf_dir, "raw_artifacts"))


def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the layout written out: rows and fields of each, by the table they refer to."""
    raw = table(spark, sf_dir, "raw_artifacts")
    rows = shred.shred(raw, shred.measured_layout(raw), None, ("table_name", "capture_id", "row_id", "parent_table", "parent_id"))
    each = rows.select("table_name", "parent_table", F.coalesce(F.size("fields"), F.lit(0)).alias("n"), F.xxhash64("capture_id", "row_id").alias("key"))
    distinct = each.groupBy("table_name", "parent_table", "key").agg(F.max("n").alias("n"))
    return distinct.groupBy("table_name", "parent_table").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").cast("long").alias("n_values"))


def tag_set(tags: str) -> Column:
    """Distinct normalised tags in order; blanks and nulls dropped, null as empty."""
    clean = F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), squeeze), lambda t: t.isNotNull() & (t != ""))
    return F.array_sort(F.array_distinct(clean))


def capture_content() -> Column:
    """Digest of what makes a capture's content: title, tags and payload, all normalised."""
    return F.md5(
        F.to_json(
            F.struct(
                F.coalesce(strip("title"), F.lit("")).alias("t"), tag_set("tags").alias("g"),
                F.coalesce(normal_hash("payload_sha256"), F.lit("")).alias("p"),
            )
        )
    )


def capture_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of captures by the run that first saw them; a partition is a source and month."""
    seen = materialize(incremental.arrivals(table(spark, sf_dir, "ingest_manifest"), table(spark, sf_dir, "ingest_run")), "arrivals")
    part = F.regexp_extract("manifest_key", r"^raw/(.*)/[^/]*$", 1)
    return incremental.stage(
        table(spark, sf_dir, "raw_artifacts"), seen, "capture_id", seconds_text("crawled_at"), capture_content(), F.translate(part, "/", "_")
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each successful run the captures that are new or changed since the one before: run by run
    through the store, each reading what arrived for it."""
    order = incremental.run_order(table(spark, sf_dir, "ingest_run"))
    log = incremental.catch_up(spark, scratch_path(spark, "captures"), capture_versions(spark, sf_dir), order)
    return log.select("run_seq", F.col("record_key").alias("capture_id"))


P4_SQL = r"""
WITH landed AS (
  SELECT manifest_key, min(landed_at) AS landed_at FROM ingest_manifest WHERE manifest_key IS NOT NULL GROUP BY 1
), done AS (
  SELECT run_seq, started_at, lag(run_seq) OVER (ORDER BY started_at, run_seq) AS before
  FROM ingest_run WHERE status = 'done'
), rows AS (
  SELECT capture_id, landed_at, left(replace(replace(crawled_at, 'T', ' '), 'Z', ''), 19) AS seen_at,
         coalesce(regexp_replace(title, '^\s+|\s+$', '', 'g'), '') AS title,
         list_sort(list_distinct(list_filter(list_transform(coalesce(tags, []::VARCHAR[]),
           lambda t: regexp_replace(lower(trim(regexp_replace(t, '\s+', ' ', 'g'))), '^\s+|\s+$', '', 'g')), lambda t: t <> ''))) AS tags,
         coalesce(regexp_replace(lower(trim(regexp_replace(payload_sha256, '\s+', '', 'g'))), '^sha256:', ''), '') AS payload
  FROM raw_artifacts JOIN landed USING (manifest_key)
  WHERE length(left(replace(replace(crawled_at, 'T', ' '), 'Z', ''), 19)) = 19 AND capture_id IS NOT NULL
), current AS (
  SELECT run_seq, before, capture_id, max({'seen_at': seen_at, 'title': title, 'tags': tags, 'payload': payload}) AS c
  FROM done JOIN rows ON rows.landed_at <= done.started_at GROUP BY 1, 2, 3
)
SELECT CAST(n.run_seq AS INT) AS run_seq, n.capture_id
FROM current n LEFT JOIN current o ON o.run_seq = n.before AND o.capture_id = n.capture_id
WHERE o.capture_id IS NULL OR n.c.title <> o.c.title OR n.c.tags <> o.c.tags OR n.c.payload <> o.c.payload
"""

QUERIES = {
    "p2_found": p2_found, "p2_versions": p2_versions, "p2_unified": p2_unified,
    "p3_found": p3_found, "p3_subgraphs": p3_subgraphs, "p3_layout": p3_layout, "p3_tables": p3_tables,
    "p4_found": p4_found,
}
SQL = {"p2_found": P2_SQL, "p2_versions": P2_VERSIONS_SQL, "p4_found": P4_SQL}
