"""Queries of the lake's own operators on the test tables, with the SQL that checks them.

Where a table of the lake has no counterpart among the test tables a stand-in is used, and the
query's docstring says which.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions.graph import CANVAS_CLASSES, derive
from graphloom.functions.jsontext import decode_object
from graphloom.functions.text import blob_key, error_text, host, manifest_key, normal_repo, seconds_text, total_size
from graphloom.operators import attribution, health, listing, queue
from graphloom.operators.shred import graphs
from graphloom.operators.state import absent, forget, latest, update, upsert
from graphloom.plans.ingest import derive_documents
from graphloom.plans.tables import table
from graphloom.sources.dimensions import declared_inputs
from graphloom.sources.manifests import blob_rows, write_blobs
from graphloom.sources.shared import materialize, scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if SQL can say it."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


CANVAS_SQL = ", ".join(f"('{c}')" for c in CANVAS_CLASSES)
REPO_SQL = r"lower(regexp_replace(regexp_replace(regexp_replace(rtrim(trim(coalesce({0}, '')), '/'), '^https?://', ''), '^www\.', ''), '\.git$', ''))"


def repo_sql(column: str) -> str:
    return REPO_SQL.format(column)


# --- scalar functions ---------------------------------------------------------------------


@query(f"SELECT repo_url, {repo_sql('repo_url')} AS repo FROM packs")
def repo_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository addresses in normal form (F1)."""
    return table(spark, sf_dir, "packs").select("repo_url", normal_repo("repo_url").alias("repo"))


@query(r"""
SELECT capture_id, manifest_key, crawled_at,
  CASE WHEN length(replace(replace(crawled_at, 'T', ' '), 'Z', '')) >= 19 THEN left(replace(replace(crawled_at, 'T', ' '), 'Z', ''), 19) END AS seconds
FROM raw_artifacts""")
def iso_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl times by the rule of 19 characters."""
    return table(spark, sf_dir, "raw_artifacts").select("capture_id", "manifest_key", "crawled_at", seconds_text("crawled_at").alias("seconds"))


@query(r"""
SELECT source, regexp_extract(fetch_url, '^[a-z]+://([^/:]+)', 1) AS host, count(*) AS n FROM raw_artifacts
WHERE fetch_url LIKE '%://%' GROUP BY 1, 2""")
def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by source and host (F16)."""
    rows = table(spark, sf_dir, "raw_artifacts").filter(F.col("fetch_url").contains("://"))
    return rows.groupBy("source", host("fetch_url").alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""
SELECT fetch_url, substr(sha256(fetch_url || '.jpg'), 1, 2) < '06' AS worth FROM (SELECT DISTINCT fetch_url FROM raw_artifacts WHERE fetch_url IS NOT NULL)""")
def canary_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stable sample of barren files (P4). Stand-in: every fetch_url as if it were a JPEG."""
    urls = table(spark, sf_dir, "raw_artifacts").filter(F.col("fetch_url").isNotNull()).select("fetch_url").distinct()
    return urls.select("fetch_url", listing.worth_fetching(F.concat("fetch_url", F.lit(".jpg"))).alias("worth"))


@query(r"""
SELECT DISTINCT payload_kind, payload_sha256, 'blob/' || substr(payload_sha256, 1, 2) || '/' || payload_sha256 || '.json.gz' AS bucket_key
FROM raw_artifacts WHERE payload_sha256 <> ''""")
def blob_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of payload blobs."""
    rows = table(spark, sf_dir, "raw_artifacts").filter("payload_sha256 <> ''")
    return rows.select("payload_kind", "payload_sha256", blob_key("payload_sha256", "payload_kind").alias("bucket_key")).distinct()


@query(r"""
SELECT user_id, n, CASE WHEN n < 3 THEN 0 ELSE least(900 * power(2, least(n - 3, 40))::BIGINT, 86400) END::BIGINT AS seconds
FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)""")
def backoff_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubling, capped delay (F17). Stand-in: error events per user as failures in a row."""
    n = table(spark, sf_dir, "events").filter("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("user_id", "n", health.backoff_seconds(F.col("n")).alias("seconds"))


@query(r"SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def devalue_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened payloads decoded (F13). Stand-in: props of events, flattened first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from graphloom.functions.devalue import decode, encode

        for batch in batches:
            values = []
            for props in batch.column(1).to_pylist():
                try:
                    back = decode(encode(json.loads(props)))
                    values.append(back.get("k") if isinstance(back, dict) else None)
                except (ValueError, TypeError, IndexError):
                    values.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["event_id", "k"])

    return table(spark, sf_dir, "events").select("event_id", "props").mapInArrow(run, "event_id bigint, k bigint").filter("k IS NOT NULL")


# --- state tables -------------------------------------------------------------------------


@query("""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each key (W2, A12). Stand-in: events by user and type."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("""
SELECT count(*) AS physical, count(DISTINCT (workflow_id, node_id)) AS logical FROM derived_workflow_nodes
WHERE workflow_id IS NOT NULL AND node_id IS NOT NULL""")
def physical_logical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows there are and rows there would be after compaction."""
    rows = table(spark, sf_dir, "derived_workflow_nodes").filter("workflow_id IS NOT NULL AND node_id IS NOT NULL")
    return rows.agg(F.count(F.lit(1)).alias("physical"), F.count_distinct("workflow_id", "node_id").alias("logical"))


@query("""
SELECT DISTINCT workflow_id FROM derived_workflows n WHERE batch_no = 12 AND workflow_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM derived_workflows o WHERE o.batch_no < 12 AND o.workflow_id = n.workflow_id)""")
def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only keys not yet held are put in (K8, J10, J12): workflows of the last batch."""
    flows = table(spark, sf_dir, "derived_workflows").filter("workflow_id IS NOT NULL")
    return absent(flows.filter("batch_no = 12").select("workflow_id"), flows.filter("batch_no < 12").select("workflow_id"), ["workflow_id"])


@query("""
WITH o AS (SELECT user_id, max(event_id) AS cursor, max(value) AS frontier FROM events WHERE event_type = 'click' GROUP BY 1),
n AS (SELECT user_id, max(event_id) AS cursor, CASE WHEN user_id % 2 = 1 THEN max(value) END AS frontier FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT coalesce(o.user_id, n.user_id) AS user_id, CASE WHEN n.user_id IS NULL THEN o.cursor ELSE n.cursor END AS cursor,
  CASE WHEN n.user_id IS NULL THEN o.frontier ELSE coalesce(n.frontier, o.frontier) END AS frontier
FROM o FULL JOIN n ON o.user_id = n.user_id""")
def upsert_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert that keeps a held value where the new one is null (K9). Stand-in: users as streams."""
    events = table(spark, sf_dir, "events")
    state = lambda kind, frontier: events.filter(F.col("event_type") == kind).groupBy("user_id").agg(F.max("event_id").alias("cursor"), frontier.alias("frontier"))
    fresh = state("purchase", F.max("value")).withColumn("frontier", F.when(F.col("user_id") % 2 == 1, F.col("frontier")))
    return upsert(state("click", F.max("value")), fresh, ["user_id"], ["frontier"])


@query("""
SELECT run_seq, run_id, CASE WHEN status = 'killed' THEN 'failed' ELSE status END AS status,
  CASE WHEN status = 'killed' THEN 'killed before its end' END AS error FROM ingest_run""")
def update_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed update (K10): runs without an end become failed runs with an error."""
    runs = table(spark, sf_dir, "ingest_run").select("run_seq", "run_id", "status", F.lit(None).cast("string").alias("error"))
    killed = runs.filter("status = 'killed'").select("run_seq", F.lit("failed").alias("status"), F.lit("killed before its end").alias("error"))
    return update(runs, killed, ["run_seq"])


@query("SELECT doc_id FROM documents WHERE posted_at IS NULL OR posted_at >= TIMESTAMPTZ '2026-06-01 00:00:00+00'")
def gc_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention (T3, R15, K11): expired rows are found, then forgotten. Stand-in: documents older
    than a date as blobs; the result is what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "posted_at")
    blobs = docs.select(F.col("doc_id").alias("sha256"), F.col("posted_at").alias("expires_at"))
    past = queue.expired(blobs, F.timestamp_seconds(F.lit(1780272000)))
    return forget(docs, past.select(F.col("sha256").alias("doc_id")), ["doc_id"]).select("doc_id")


@query("SELECT sha256(text) AS sha256, octet_length(encode(min(text))) AS bytes, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1")
def blob_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content addressed storing (F4, K2): each digest once, as an object in the shared folder. Stand-in:
    texts as payloads."""
    payloads = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select(F.encode("text", "UTF-8").alias("content"), F.lit("workflow").alias("kind"))
    written = materialize(write_blobs(payloads, scratch_path(spark, "objects")), "written")
    none = spark.createDataFrame([], "sha256 string, kind_class string")
    stored = blob_rows(written, none).select("sha256", F.col("bytes").cast("long").alias("bytes"))
    return stored.join(written.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies")), "sha256")


# --- aggregates ---------------------------------------------------------------------------


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE workflow_id <> '') AS with_workflow FROM raw_artifacts GROUP BY 1")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures and those with a workflow."""
    return table(spark, sf_dir, "raw_artifacts").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("workflow_id") != "").alias("with_workflow")
    )


@query("SELECT format, count(*) AS n, CAST(sum(node_count) AS BIGINT) AS nodes FROM derived_workflows GROUP BY 1")
def by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workflows and nodes by format."""
    return table(spark, sf_dir, "derived_workflows").groupBy("format").agg(F.count(F.lit(1)).alias("n"), F.sum("node_count").alias("nodes"))


@query("SELECT class_type, count(*) AS n FROM derived_workflow_nodes GROUP BY 1 ORDER BY n DESC, class_type LIMIT 3")
def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent classes (A10); the class decides between equals."""
    n = table(spark, sf_dir, "derived_workflow_nodes").groupBy("class_type").agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), "class_type").limit(3)


@query("SELECT workflow_id, class_type, count(*) AS n FROM derived_workflow_nodes GROUP BY 1, 2")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of each workflow as a multiset (A5)."""
    return table(spark, sf_dir, "derived_workflow_nodes").groupBy("workflow_id", "class_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT http_status, channel, count(*) AS n, CAST(sum(bytes_fetched) AS BIGINT) AS bytes, coalesce(max(total_size), 0) AS largest FROM raw_artifacts GROUP BY 1, 2""")
def fetch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and bytes by status."""
    return table(spark, sf_dir, "raw_artifacts").groupBy("http_status", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes_fetched").alias("bytes"), F.coalesce(F.max("total_size"), F.lit(0)).alias("largest")
    )


@query("""
SELECT source, yyyymm, count(DISTINCT manifest_key) AS manifests, count(*) AS listings, CAST(sum(row_count) AS BIGINT) AS row_total,
  strftime(max(landed_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_landed FROM ingest_manifest GROUP BY 1, 2""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of what landed."""
    return table(spark, sf_dir, "ingest_manifest").groupBy("source", "yyyymm").agg(
        F.count_distinct("manifest_key").alias("manifests"), F.count(F.lit(1)).alias("listings"),
        F.sum("row_count").alias("row_total"), F.date_format(F.max("landed_at"), "yyyy-MM-dd HH:mm:ss").alias("last_landed"),
    )


@query("SELECT DISTINCT source, source_artifact_id FROM raw_artifacts WHERE payload_kind <> 'none'")
def distinct_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids that are held (A17). Stand-in: artifacts with a payload as posts."""
    return table(spark, sf_dir, "raw_artifacts").filter("payload_kind <> 'none'").select("source", "source_artifact_id").distinct()


# --- attribution --------------------------------------------------------------------------

ATTRIBUTION_SQL = f"""
WITH repos AS (
  SELECT repo, arg_min(pack_id, (CASE WHEN coalesce(cnr_id, '') = '' THEN 1 ELSE 0 END, pack_id)) AS pack_id FROM (
    SELECT {repo_sql("coalesce(nullif(repo, ''), repo_url)")} AS repo, pack_id, cnr_id FROM packs) WHERE repo <> '' AND pack_id <> '' GROUP BY 1
), listed AS (
  SELECT DISTINCT class_type, coalesce(nullif(pack_id, ''), repo) AS ident FROM pack_nodes WHERE class_type IS NOT NULL
), named AS (
  SELECT class_type, list_sort(list(DISTINCT coalesce(r.pack_id, l.ident))) AS packs
  FROM listed l LEFT JOIN repos r ON r.repo = {repo_sql("l.ident")} WHERE l.ident <> '' GROUP BY 1
), core AS (
  SELECT class_type, bool_or(h) AS hidden FROM (
    SELECT class_type, coalesce(hidden_prompt, false) AS h FROM core_classes UNION ALL SELECT c, false FROM (VALUES {CANVAS_SQL}) t(c)) GROUP BY 1
), attributed AS (
  SELECT n.workflow_id, n.node_id, n.class_type, n.cnr_id, n.aux_id, n.mode, c.class_type IS NOT NULL AS is_core, coalesce(c.hidden, false) AS hidden_prompt,
    coalesce(n.cnr_id, '') NOT IN ('', 'comfy-core') AS stamped, coalesce(s.pack_id, n.cnr_id) AS stamp_pack, coalesce(m.packs, []) AS names
  FROM derived_workflow_nodes n LEFT JOIN core c ON c.class_type = n.class_type LEFT JOIN named m ON m.class_type = n.class_type
  LEFT JOIN repos s ON s.repo = {repo_sql("n.cnr_id")}
), final AS (
  SELECT *, CASE WHEN stamped THEN [stamp_pack] WHEN is_core THEN []::VARCHAR[] ELSE names END AS found,
    NOT stamped AND NOT is_core AND len(names) > 1 AS pack_ambiguous, NOT stamped AND NOT is_core AND len(names) = 0 AS pack_unknown
  FROM attributed
)"""


def _attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = materialize(attribution.repo_packs(table(spark, sf_dir, "packs")), "repos")
    core = materialize(attribution.core_flags(table(spark, sf_dir, "core_classes")), "core")
    named = materialize(attribution.class_packs(table(spark, sf_dir, "pack_nodes"), repos), "named")
    nodes = table(spark, sf_dir, "derived_workflow_nodes").select("workflow_id", "node_id", "class_type", "cnr_id", "ver", "aux_id", "mode")
    return attribution.attribute(nodes, core, named, repos, ["workflow_id", "node_id"])


@query(ATTRIBUTION_SQL + """
SELECT class_type, cnr_id, is_core, hidden_prompt, array_to_string(found, ',') AS packs, pack_ambiguous, pack_unknown, count(*) AS n
FROM final GROUP BY ALL""")
def attributed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution of every node row (J1 to J3, G4, E1), counted by outcome."""
    return _attributed(spark, sf_dir).withColumn("packs", F.array_join("packs", ",")).groupBy(
        "class_type", "cnr_id", "is_core", "hidden_prompt", "packs", "pack_ambiguous", "pack_unknown"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(ATTRIBUTION_SQL + """
SELECT workflow_id, array_to_string(list_sort(list_distinct(flatten(list(found)))), ',') AS pack_set, len(list_distinct(flatten(list(found)))) AS pack_set_size,
  count(*) FILTER (WHERE coalesce(cnr_id, '') <> '' OR coalesce(aux_id, '') <> '') AS stamped_nodes, count(*) FILTER (WHERE coalesce(cnr_id, '') <> '') AS cnr_nodes,
  count(*) FILTER (WHERE coalesce(aux_id, '') <> '') AS aux_nodes, count(*) FILTER (WHERE mode IN (2, 4)) AS muted_or_bypassed,
  count(*) FILTER (WHERE hidden_prompt) AS hidden_prompt_nodes
FROM final GROUP BY 1""")
def pack_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per workflow its pack set and the conditional counts (A2 to A4)."""
    summary = attribution.workflow_packs(_attributed(spark, sf_dir))
    return summary.withColumns({"pack_set": F.array_join("pack_set", ","), "pack_set_size": F.col("pack_set_size").cast("long")})


@query(f"SELECT class_type FROM core_classes WHERE class_type IS NOT NULL UNION SELECT c FROM (VALUES {CANVAS_SQL}) t(c)")
def core_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core classes and those of the canvas as one set."""
    return attribution.core_flags(table(spark, sf_dir, "core_classes")).select("class_type")


# --- windows ------------------------------------------------------------------------------


@query("""
SELECT workflow_id, node_id, class_type, row_number() OVER (PARTITION BY workflow_id ORDER BY class_type, node_id) - 1 AS rank
FROM (SELECT DISTINCT workflow_id, node_id, class_type FROM derived_workflow_nodes)""")
def node_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of each node by class within its workflow."""
    nodes = table(spark, sf_dir, "derived_workflow_nodes").select("workflow_id", "node_id", "class_type").distinct()
    return queue.per_key_rank(nodes, ["workflow_id"], [F.asc_nulls_last("class_type"), F.asc_nulls_last("node_id")]).withColumn("rank", F.col("rank").cast("long"))


@query("""
SELECT manifest_key, workflow_id, min(capture_id) AS capture_id FROM raw_artifacts WHERE workflow_id <> '' GROUP BY 1, 2""")
def first_sighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First record of each workflow in a manifest (W4). The capture id stands for the line."""
    rows = table(spark, sf_dir, "raw_artifacts").filter("workflow_id <> ''").select("manifest_key", "workflow_id", "capture_id")
    return rows.groupBy("manifest_key", "workflow_id").agg(F.min("capture_id").alias("capture_id"))


STREAK_SQL = """
WITH log AS (SELECT user_id, ts, event_id, event_type = 'error' AS bad, event_type IN ('click', 'purchase') AS good FROM events),
runs AS (SELECT *, sum(good::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM log WHERE bad OR good),
streaks AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS streak FROM runs WHERE bad)"""


def _hour() -> Column:
    return F.date_trunc("hour", "ts")


def _outcomes() -> tuple[Column, Column]:
    return F.col("event_type") == "error", F.col("event_type").isin("click", "purchase")


@query(STREAK_SQL + """
SELECT user_id, ts, event_id, streak FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM streaks WHERE streak >= 3) WHERE n = 1""")
def refusal_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refusal that latches each host (W5, R6). Stand-in: users as hosts, errors as refusals,
    clicks and purchases as successes."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    latched = health.latches(log, "user_id", ["ts", "event_id"], *_outcomes(), slices=_hour())
    return latched.select("user_id", "ts", "event_id", F.col("streak").cast("long").alias("streak"))


@query(STREAK_SQL + """
SELECT user_id, event_id, streak, CASE WHEN streak < 3 THEN 0 ELSE least(900 * power(2, least(streak - 3, 40))::BIGINT, 86400) END::BIGINT AS seconds FROM streaks""")
def transient_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaks of failures and the delay after each (W7, R7). Stand-in as for the latch."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    rows = health.backoffs(log, "user_id", ["ts", "event_id"], *_outcomes(), slices=_hour())
    return rows.select("user_id", "event_id", F.col("streak").cast("long").alias("streak"), F.col("seconds").cast("long").alias("seconds"))


@query(STREAK_SQL + """
, latched AS (SELECT DISTINCT user_id FROM streaks WHERE streak >= 3),
waiting AS (SELECT user_id, max(ts) AS ts FROM streaks WHERE streak >= 2 GROUP BY 1)
SELECT u.user_id, CASE WHEN l.user_id IS NOT NULL THEN 'latched' WHEN w.ts > (SELECT max(ts) - INTERVAL 7 DAY FROM events) THEN 'backing_off' ELSE 'open' END AS verdict
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN latched l USING (user_id) LEFT JOIN waiting w USING (user_id)""")
def host_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a host may be asked (R8, P16): a latch comes before a backoff. Stand-in as for the
    latch; two errors in a row within the last week count as a backoff."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    rows = materialize(health.streaks(events, "user_id", ["ts", "event_id"], *_outcomes(), slices=_hour()), "streaks")
    now = events.agg(F.max("ts").alias("ts")).head()["ts"]
    return health.gate(
        events, rows.filter("streak >= 3"), rows.filter("streak >= 2"), "user_id", "ts", F.lit(now) - F.make_interval(days=F.lit(7))
    )


@query("""
WITH first AS (SELECT min(event_id) AS event_id FROM events GROUP BY user_id),
pages AS (SELECT e.event_id // 100 AS page, count(f.event_id) AS new_rows FROM events e LEFT JOIN first f USING (event_id) GROUP BY 1),
two AS (SELECT *, new_rows = 0 AND lag(new_rows) OVER (ORDER BY page) = 0 AS stop FROM pages)
SELECT page, new_rows FROM two WHERE page <= coalesce((SELECT min(page) FROM two WHERE stop), (SELECT max(page) FROM two))""")
def tip_dry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read until two in a row bring nothing new (W6, R13). Stand-in: events in pages of a
    hundred, a user's first event is new."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("event_id").alias("event_id")).select("event_id", F.lit(1).alias("_new"))
    pages = events.select("event_id").join(first, "event_id", "left").groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(F.count("_new").alias("new_rows"))
    return health.until_dry(pages, "page", "new_rows")


# --- the work queue -----------------------------------------------------------------------


def _orders_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the queue: orders, open ones pending, those in process leased until 30 days
    after their date, the rest done; priority by the first digit of theirs."""
    state = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "leased").otherwise("done")
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("artifact_id"), F.col("o_custkey").cast("string").alias("post_id"),
        at.alias("published_at"), (F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority"), state.alias("state"),
        F.when(state == "leased", at + F.make_interval(days=F.lit(30))).alias("lease_until"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("last_error"),
    )


QUEUE_SQL = """
WITH q AS (
  SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS artifact_id, o_custkey::VARCHAR AS post_id, o_orderdate AS published_at, 6 - left(o_orderpriority, 1)::INT AS priority,
    CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'leased' ELSE 'done' END AS state,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY END AS lease_until
  FROM orders)"""
NOW_SQL = "TIMESTAMP '1997-01-01 00:00:00'"


def _now() -> Column:
    return F.timestamp_seconds(F.lit(852076800))


@query(QUEUE_SQL + f"""
SELECT artifact_id, priority FROM q WHERE state = 'pending' OR (state = 'leased' AND lease_until < {NOW_SQL})
ORDER BY priority DESC, published_at DESC NULLS LAST, artifact_id LIMIT 50""")
def claim_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of fifty claimed from the queue."""
    claimed, _ = queue.claim(_orders_queue(spark, sf_dir), "orders", 50, _now())
    return claimed.select("artifact_id", "priority")


@query(QUEUE_SQL + f"""
SELECT state, coalesce(lease_until < {NOW_SQL}, false) AS is_expired, count(*) AS n FROM q GROUP BY 1, 2""")
def lease_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases by whether they have run out."""
    return _orders_queue(spark, sf_dir).groupBy("state", F.coalesce(F.col("lease_until") < _now(), F.lit(False)).alias("is_expired")).agg(F.count(F.lit(1)).alias("n"))


@query(QUEUE_SQL + f"""
SELECT CASE WHEN state = 'leased' AND lease_until < {NOW_SQL} THEN 'pending' ELSE state END AS state, count(*) AS n FROM q GROUP BY 1""")
def release_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue by state after expired leases were given back."""
    rows = materialize(_orders_queue(spark, sf_dir), "queue")
    past = rows.filter((F.col("state") == "leased") & (F.col("lease_until") < _now()))
    return queue.queue_stats(queue.release(rows, past)).select("state", "n")


@query(QUEUE_SQL + " SELECT 'orders' AS source, state, count(*) AS n FROM q GROUP BY 2")
def queue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows by state."""
    return queue.queue_stats(_orders_queue(spark, sf_dir))


@query("""
SELECT source, 'user' AS kind, count(*) FILTER (WHERE done) AS exhausted, count(*) FILTER (WHERE NOT done) AS pending
FROM (SELECT source, author_id, bool_and(workflow_id = '') AS done FROM raw_artifacts WHERE author_id <> '' GROUP BY 1, 2) GROUP BY 1""")
def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions by kind and state (A7, E4). Stand-in: authors, exhausted if without a workflow."""
    users = table(spark, sf_dir, "raw_artifacts").filter("author_id <> ''").groupBy("source", "author_id").agg(F.bool_and(F.col("workflow_id") == "").alias("exhausted"))
    return queue.partition_stats(users.withColumn("kind", F.lit("user")))


@query("""
SELECT key FROM (SELECT author_id AS key, max(crawled_at) AS swept_at FROM raw_artifacts WHERE author_id <> '' GROUP BY 1)
ORDER BY swept_at NULLS FIRST, key LIMIT 1""")
def next_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition swept longest ago (T2, P15). Stand-in: authors by their last crawl text."""
    users = table(spark, sf_dir, "raw_artifacts").filter("author_id <> ''").groupBy(F.col("author_id").alias("key")).agg(F.max("crawled_at").alias("swept_at"))
    none = F.lit(None).cast("timestamp")
    rows = users.select(F.lit("s").alias("source"), F.lit("user").alias("kind"), "key", "swept_at", F.lit(False).alias("exhausted"), none.alias("lease_until"), none.alias("discovered_at"))
    claimed, _ = queue.claim_partition(rows, "s", "user", _now())
    return claimed.select("key")


@query(QUEUE_SQL + """
, held AS (SELECT DISTINCT post_id FROM q WHERE priority = 5 AND state IN ('done', 'leased', 'pending'))
SELECT post_id, min(artifact_id) AS artifact_id FROM q WHERE priority < 5 AND post_id NOT IN (SELECT post_id FROM held) GROUP BY 1""")
def one_per_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first item of each post that is not held (W3, J7, P11). Stand-in: customers as posts,
    their urgent orders as what is held."""
    rows = _orders_queue(spark, sf_dir)
    items = rows.filter("priority < 5").select("source", "post_id", "artifact_id", F.col("artifact_id").alias("position"))
    return queue.one_per_post(items, rows.filter("priority = 5"), "position").select("post_id", "artifact_id")


@query("SELECT DISTINCT manifest_key FROM raw_artifacts WHERE manifest_key NOT IN (SELECT manifest_key FROM ingest_manifest WHERE landed_at < TIMESTAMPTZ '2026-07-01 00:00:00+00')")
def consumed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests there are less those consumed before July."""
    listed = table(spark, sf_dir, "raw_artifacts").select("manifest_key").filter("manifest_key IS NOT NULL").distinct()
    consumed = table(spark, sf_dir, "ingest_manifest").filter(F.col("landed_at") < F.timestamp_seconds(F.lit(1782864000))).select("manifest_key")
    return listed.join(consumed.distinct(), "manifest_key", "left_anti")


@query(QUEUE_SQL + f"""
SELECT artifact_id, date_diff('second', {NOW_SQL}, lease_until) AS seconds_left FROM q WHERE lease_until > {NOW_SQL}""")
def lease_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds until a lease runs out, of those that have not."""
    rows = _orders_queue(spark, sf_dir).select("artifact_id", queue.seconds_left(F.col("lease_until"), _now()).alias("seconds_left"))
    return rows.filter("seconds_left IS NOT NULL")


@query(QUEUE_SQL + f"""
, claimed AS (SELECT artifact_id, row_number() OVER (ORDER BY priority DESC, published_at DESC NULLS LAST, artifact_id) AS n FROM q WHERE state = 'pending' OR (state = 'leased' AND lease_until < {NOW_SQL}))
SELECT artifact_id FROM claimed WHERE n <= 500 AND (n > 400 OR artifact_id LIKE '%7')""")
def leases_to_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases given back at the end of a run (E3): of five hundred claimed the last hundred were not
    processed, and of the others those whose id ends in 7 were without a stored record."""
    claimed, _ = queue.claim(_orders_queue(spark, sf_dir), "orders", 500, _now())
    claimed = materialize(claimed, "claimed")
    done = claimed.orderBy(F.desc("priority"), F.desc_nulls_last("published_at"), "artifact_id").limit(400)
    undurable = done.filter(F.col("artifact_id").endswith("7"))
    return queue.unprocessed(claimed, done, undurable.select("source", "artifact_id")).select("artifact_id")


@query("""
SELECT doc_id FROM documents WHERE posted_at < TIMESTAMPTZ '2026-06-01 00:00:00+00' ORDER BY posted_at, doc_id::VARCHAR LIMIT 100""")
def gc_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred that ran out first (T3, R15): a garbage run takes so many. Stand-in: documents posted
    before a date as blobs."""
    blobs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("sha256"), F.col("posted_at").alias("expires_at"))
    return queue.expired(blobs, F.timestamp_seconds(F.lit(1780272000)), 100).select("doc_id")


@query("""
WITH a AS (
  SELECT source, source_artifact_id, bool_or(channel LIKE 'bytes%' AND payload_kind IN ('workflow', 'prompt')) AS b, bool_or(channel = 'api' AND payload_kind IN ('workflow', 'prompt')) AS p
  FROM raw_artifacts GROUP BY 1, 2
)
SELECT source, count(*) AS artifacts, count(*) FILTER (WHERE b) AS from_bytes, count(*) FILTER (WHERE p) AS from_api, count(*) FILTER (WHERE b OR p) AS from_either FROM a GROUP BY 1""")
def channel_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each channel gives and both together (E5): artifacts with a graph by channel."""
    rows = table(spark, sf_dir, "raw_artifacts")
    graph = F.col("payload_kind").isin("workflow", "prompt")
    keys = ["source", "source_artifact_id"]
    of = lambda wanted, name: rows.filter(wanted & graph).select(*keys, F.lit(name).alias("way"))
    union = of(F.col("channel").startswith("bytes"), "bytes").unionByName(of(F.col("channel") == "api", "api"))
    every = rows.select(*keys, F.lit("none").alias("way"))
    ways = every.unionByName(union).groupBy(*keys).agg(F.bool_or(F.col("way") == "bytes").alias("b"), F.bool_or(F.col("way") == "api").alias("p"))
    return ways.groupBy("source").agg(
        F.count(F.lit(1)).alias("artifacts"), F.count_if("b").alias("from_bytes"), F.count_if("p").alias("from_api"), F.count_if(F.col("b") | F.col("p")).alias("from_either")
    )


# --- listing items ------------------------------------------------------------------------


def _listing_fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [decode_object(meta) for meta in batch.column(1).to_pylist()]
        texts = [None if obj is None else json.dumps({k: obj[k] for k in ("hasMeta", "toolIds") if k in obj}) for obj in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["source_artifact_id", "source_meta"])


@query(r"""
WITH once AS (
  SELECT source_artifact_id,
    CASE WHEN json_valid(source_meta) THEN CASE WHEN json_type(source_meta) = 'VARCHAR' THEN json_extract_string(source_meta, '$') ELSE source_meta END END AS meta
  FROM raw_artifacts WHERE source = 'galleryhub'
)
SELECT source_artifact_id, bool_or(coalesce(try_cast(json_extract(meta, '$.hasMeta') AS BOOLEAN), false)) AS has_meta,
  bool_or(list_contains(coalesce(try_cast(json_extract(meta, '$.toolIds') AS BIGINT[]), []), 86)) AS marked
FROM once WHERE json_valid(meta) AND json_type(meta) = 'OBJECT' GROUP BY 1""")
def prefilter_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an item is wanted (P2, P3), from the listing kept with each capture: every readable record,
    also those whose JSON is encoded twice or has leading blanks."""
    rows = table(spark, sf_dir, "raw_artifacts").filter("source = 'galleryhub' AND source_meta IS NOT NULL").select("source_artifact_id", "source_meta")
    meta = rows.mapInArrow(_listing_fields, "source_artifact_id string, source_meta string")
    meta = meta.select("source_artifact_id", F.try_parse_json("source_meta").alias("v")).filter("v IS NOT NULL")
    flags = meta.select(
        "source_artifact_id", F.try_variant_get("v", "$.hasMeta", "boolean").alias("has_meta"), F.try_variant_get("v", "$.toolIds", "array<int>").alias("tools")
    )
    return flags.groupBy("source_artifact_id").agg(
        F.bool_or(F.coalesce("has_meta", F.lit(False))).alias("has_meta"), F.bool_or(listing.wanted(F.col("tools"), F.col("has_meta"), "tagged")).alias("marked")
    )


@query("""
SELECT capture_id, manifest_key, crawled_at, payload_sha256, url FROM (
  SELECT *, CASE WHEN coalesce(u, '') = '' THEN NULL WHEN u LIKE 'http%' THEN u ELSE 'https://files.example/' || u || '/original=true/' || coalesce(title, u || '.png') || '' END AS url
  FROM (SELECT *, CASE WHEN channel = 'api' THEN left(payload_sha256, 12) ELSE fetch_url END AS u FROM raw_artifacts))""")
def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of files (P5): full ones stay, bare ids are put into the template with their name.
    Stand-in: digests of the second channel as ids, titles as names."""
    rows = table(spark, sf_dir, "raw_artifacts")
    given = F.when(F.col("channel") == "api", F.left("payload_sha256", F.lit(12))).otherwise(F.col("fetch_url"))
    return rows.select(
        "capture_id", "manifest_key", "crawled_at", "payload_sha256", listing.absolute_url(given, F.col("title"), "https://files.example/{id}/original=true/{name}").alias("url")
    )


@query("""
SELECT run_id, source, 'raw/' || source || '/' || strftime(landed_at, '%Y-%m') || '/' || run_id || '-' || lpad(n::VARCHAR, 4, '0') || '.jsonl.gz' AS manifest_key
FROM (SELECT DISTINCT r.run_id, m.source, m.landed_at, r.run_seq * 7 AS n FROM ingest_manifest m JOIN ingest_run r ON date_trunc('day', m.landed_at) = date_trunc('day', r.started_at))""")
def manifest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of manifests (F6). Stand-in: runs with the manifests that landed on their day."""
    runs = table(spark, sf_dir, "ingest_run").select("run_id", (F.col("run_seq") * 7).alias("n"), F.to_date("started_at").alias("day"))
    landed = table(spark, sf_dir, "ingest_manifest").select("source", "landed_at", F.to_date("landed_at").alias("day"))
    rows = landed.join(runs, "day").select("run_id", "source", "landed_at", "n").distinct()
    return rows.select("run_id", "source", manifest_key("source", "landed_at", "run_id", "n").alias("manifest_key"))


@query("""
SELECT capture_id, manifest_key, crawled_at, coalesce(CASE WHEN http_status = 206 THEN total_size WHEN http_status = 200 THEN bytes_fetched END, -1) AS size,
  nullif(left(coalesce(title, ''), 500), '') AS error FROM raw_artifacts""")
def answer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes out of response headers and errors as they are kept (F15, F20). Stand-in: headers written
    from the sizes of captures, titles as errors."""
    rows = table(spark, sf_dir, "raw_artifacts")
    ranged = F.when((F.col("http_status") == 206) & F.col("total_size").isNotNull(), F.concat(F.lit("bytes 0-99/"), F.col("total_size").cast("string")))
    return rows.select(
        "capture_id", "manifest_key", "crawled_at", F.coalesce(total_size(ranged, F.col("bytes_fetched").cast("string"), "http_status"), F.lit(-1)).cast("long").alias("size"),
        error_text(F.coalesce("title", F.lit(""))).alias("error"),
    )


@query(r"""
SELECT capture_id, manifest_key, crawled_at, map_keys(stats) IS NOT NULL AS has_stats, list_sort(map_keys(stats))::VARCHAR AS names,
  CAST(list_sum(map_values(stats)) AS BIGINT) AS total FROM raw_artifacts WHERE stats IS NOT NULL AND cardinality(stats) > 0""")
def sidecar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of an item (P1, F21): names and sum."""
    rows = table(spark, sf_dir, "raw_artifacts").filter("stats IS NOT NULL AND size(stats) > 0")
    names = F.concat(F.lit("["), F.array_join(F.array_sort(F.map_keys("stats")), ", "), F.lit("]"))
    total = F.aggregate(F.map_values("stats"), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return rows.select("capture_id", "manifest_key", "crawled_at", F.map_keys("stats").isNotNull().alias("has_stats"), names.alias("names"), total.alias("total"))


# --- graph documents ----------------------------------------------------------------------

GRAPH = (
    "workflow_id string, canonical_hash string, structural_hash string, format string, node_count bigint, link_count bigint, group_count bigint, "
    "model_edges bigint, n_nodes int, n_bindings int, links int, literals int, capture_id string, graph_path string"
)


def _graph_row(found: dict) -> list:
    bindings = found.get("bindings", [])
    links = sum(b["binding"] == "link" for b in bindings)
    names = ("workflow_id", "canonical_hash", "structural_hash", "format", "node_count", "link_count", "group_count", "model_edges")
    return [*(found.get(n) for n in names), len(found.get("nodes", [])), len(bindings), links, len(bindings) - links]


def _graph_batch(rows: list[list]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.string()] * 2
    names = [p.split()[0] for p in GRAPH.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _derive_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _graph_batch([
            [*_graph_row(derive(json.loads(text))), key, ""] for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ])


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey", "l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))


API_SQL = """
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey, l_linestatus, l_returnflag FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey::VARCHAR AS workflow, count(*) AS node_count, count(*) FILTER (WHERE l_linestatus = 'F') AS link_count,
  count(*) FILTER (WHERE l_linestatus = 'F') AS links, count(*) FILTER (WHERE l_linestatus <> 'F') AS literals, 'api' AS format FROM l GROUP BY 1"""


def _prompt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, document): a line is a node, its part's type the class; lines of status F are
    fed by a link."""
    lines = _order_lines(spark, sf_dir)
    fed = F.when(F.col("l_linestatus") == "F", F.lit('["1",0]')).otherwise(F.lit('"a.bin"'))
    entry = F.concat(
        F.lit('"'), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linestatus"), F.col("l_returnflag"), F.lit('":{"class_type":"'), F.col("p_type"),
        F.lit('","inputs":{"ckpt_name":'), fed, F.lit("}}"),
    )
    return lines.groupBy("l_orderkey").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ","), F.lit("}")).alias("document"))


@query(API_SQL)
def api_graph_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt documents made from orders, run through the derivation and counted."""
    documents = _prompt_documents(spark, sf_dir)
    derived = documents.select(F.col("l_orderkey").cast("string").alias("key"), "document").mapInArrow(_derive_text, GRAPH)
    return derived.select(
        F.col("capture_id").alias("workflow"), "node_count", "link_count", F.col("links").cast("long").alias("links"), F.col("literals").cast("long").alias("literals"), "format"
    )


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey, l_linestatus, l_returnflag, p_type FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT p_type AS class_type, 'ckpt_name' AS input, CASE WHEN l_linestatus = 'F' THEN 'link' ELSE 'literal' END AS binding, count(*) AS n FROM l GROUP BY 1, 3""")
def binding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each loader input holds a literal or is fed by a link (A11), over the documents of
    the round trip."""
    documents = _prompt_documents(spark, sf_dir).select(F.col("l_orderkey").cast("string").alias("sha256"), "document")
    bindings = derive_documents(documents).select(F.explode("bindings").alias("b")).select("b.*")
    return bindings.groupBy("class_type", "input", "binding").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey, l_linestatus, l_returnflag FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey::VARCHAR AS workflow, count(*) AS node_count, count(*) FILTER (WHERE l_returnflag = 'R') AS link_count,
  count(*) FILTER (WHERE l_returnflag = 'R') AS model_edges, 'save' AS format FROM l GROUP BY 1""")
def save_graph_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canvas documents made from orders (returned lines have a model link), as above."""
    derived = _canvas_documents(spark, sf_dir).select(F.col("l_orderkey").cast("string").alias("key"), "document").mapInArrow(_derive_text, GRAPH)
    return derived.select(F.col("capture_id").alias("workflow"), "node_count", "link_count", "model_edges", "format")


def _canvas_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, document): a line is a node; returned ones have a link to themselves."""
    lines = _order_lines(spark, sf_dir)
    key = F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linestatus"), F.col("l_returnflag"))
    node = F.concat(F.lit('{"id":"'), key, F.lit('","type":"'), F.col("p_type"), F.lit('","mode":0,"properties":{"cnr_id":"pack-a"}}'))
    link = F.when(F.col("l_returnflag") == "R", F.concat(F.lit('[1,"'), key, F.lit('",0,"'), key, F.lit('",0,["MODEL","CLIP"]]')))
    return lines.groupBy("l_orderkey").agg(
        F.concat(
            F.lit('{"nodes":['), F.array_join(F.array_sort(F.collect_list(node)), ","), F.lit('],"links":['), F.array_join(F.array_sort(F.collect_list(link)), ","),
            F.lit('],"version":0.4}'),
        ).alias("document")
    )


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey, l_linestatus, l_returnflag, p_type FROM lineitem JOIN part ON p_partkey = l_partkey),
shown AS (
  SELECT p_type, 'ckpt_name' AS input, CASE WHEN l_returnflag = 'R' THEN 'link' ELSE 'literal' END AS binding, 'save.inputs' AS evidence FROM l WHERE l_linestatus = 'F'
), missing AS (
  SELECT p_type, 'ckpt_name' AS input, 'literal' AS binding, 'save.widget' AS evidence FROM l WHERE l_linestatus <> 'F' AND p_type LIKE 'S%'
  UNION ALL SELECT p_type, 'vae_name', 'literal', 'save.widget' FROM l WHERE p_type LIKE 'S%'
)
SELECT p_type AS class_type, input, binding, evidence, count(*) AS n FROM (SELECT * FROM shown UNION ALL SELECT * FROM missing) GROUP BY 1, 2, 3, 4""")
def save_binding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loader inputs of canvas documents (G5, J4): shown ones, fed by a link or not, and those that the
    class declares and the document leaves out. Stand-in: lines of orders as nodes, their part's type
    as class; those of status F show an input, classes with S declare two and a third that is no loader
    input."""
    lines = _order_lines(spark, sf_dir)
    fed = F.when(F.col("l_returnflag") == "R", F.lit("3")).otherwise(F.lit("null"))
    shown = F.when(F.col("l_linestatus") == "F", F.concat(F.lit(',"inputs":[{"name":"x","widget":{"name":"ckpt_name"},"link":'), fed, F.lit("}]"))).otherwise(F.lit(""))
    key = F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linestatus"), F.col("l_returnflag"))
    node = F.concat(F.lit('{"id":"'), key, F.lit('","type":"'), F.col("p_type"), F.lit('"'), shown, F.lit("}"))
    documents = lines.groupBy(F.col("l_orderkey").cast("string").alias("sha256")).agg(
        F.concat(F.lit('{"nodes":['), F.array_join(F.array_sort(F.collect_list(node)), ","), F.lit("]}")).alias("document")
    )
    inputs = table(spark, sf_dir, "part").filter("p_type LIKE 'S%'").select(
        F.col("p_type").alias("class_type"), F.explode(F.array(F.lit("ckpt_name"), F.lit("vae_name"), F.lit("strength"))).alias("input")
    ).distinct()
    bindings = derive_documents(documents, declared_inputs(inputs)).select(F.explode("bindings").alias("b")).select("b.*")
    return bindings.groupBy("class_type", "input", "binding", "evidence").agg(F.count(F.lit(1)).alias("n"))


def _identities(rows: str, form: str, document: str, edge: str, edge_order: str, outline: str) -> str:
    """SQL for the three identities of documents from their nodes: (o, t, entry, w, linked) by node."""
    graph = lambda values, rank: (
        f"""sha256('{{"e":[' || coalesce(string_agg({edge.format(r=rank)}, ',' ORDER BY {edge_order.format(r=rank)}) FILTER (WHERE linked), '')"""
        f""" || '],"n":[' || string_agg('["' || t || '","' || {values} || '"]', ',' ORDER BY {rank}) || ']}}')"""
    )
    return f"""
SELECT o::VARCHAR AS workflow, '{form}' AS format, sha256({document}) AS workflow_id, {graph("w", "r")} AS canonical_hash, {graph(outline, "r2")} AS structural_hash
FROM (SELECT *, row_number() OVER (PARTITION BY o ORDER BY t, w, entry) - 1 AS r, row_number() OVER (PARTITION BY o ORDER BY t, {outline}, entry) - 1 AS r2 FROM {rows}) GROUP BY o"""


IDENTITY_SQL = r"""
WITH l AS (SELECT DISTINCT l_orderkey AS o, l_partkey::VARCHAR || '-' || l_linestatus || l_returnflag AS k, l_linestatus AS s, l_returnflag AS f, p_type AS t FROM lineitem JOIN part ON p_partkey = l_partkey),
api AS (
  SELECT o, t, s = 'F' AS linked, CASE WHEN s = 'F' THEN '{}' ELSE '{\"ckpt_name\": \"a.bin\"}' END AS w, CASE WHEN s = 'F' THEN '[]' ELSE '[\"ckpt_name\"]' END AS names,
    '"' || k || '":{"class_type":"' || t || '","inputs":{"ckpt_name":' || CASE WHEN s = 'F' THEN '["1",0]' ELSE '"a.bin"' END || '}}' AS entry FROM l
), save AS (
  SELECT o, t, f = 'R' AS linked, 'null' AS w, '{"id":"' || k || '","type":"' || t || '","mode":0,"properties":{"cnr_id":"pack-a"}}' AS entry,
    '{"id":"' || k || '","mode":0,"properties":{"cnr_id":"pack-a"},"type":"' || t || '"}' AS plain, '[1,"' || k || '",0,"' || k || '",0,["MODEL","CLIP"]]' AS link FROM l
)""" + _identities(
    "api", "api", "'{' || string_agg(entry, ',' ORDER BY entry) || '}'", """'[-1,0,' || {r} || ',"ckpt_name"]'""", """'[-1, 0, ' || {r} || ', "ckpt_name"]'""", "names",
) + " UNION ALL " + _identities(
    "save", "save",
    """'{"links":[' || coalesce(string_agg(link, ',' ORDER BY link) FILTER (WHERE linked), '') || '],"nodes":[' || string_agg(plain, ',' ORDER BY entry) || '],"version":0.4}'""",
    """'[' || {r} || ',0,' || {r} || ',0,["MODEL","CLIP"]]'""", """'[' || {r} || ', 0, ' || {r} || ', 0, ["MODEL", "CLIP"]]'""", "''",
)


@query(IDENTITY_SQL)
def graph_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, canonical and structural identity (G7, F8, F9, F24) of the documents of both round trips;
    the SQL writes out the text of each identity and hashes it."""
    documents = [d.select(F.col("l_orderkey").cast("string").alias("key"), "document") for d in (_prompt_documents(spark, sf_dir), _canvas_documents(spark, sf_dir))]
    derived = documents[0].unionByName(documents[1]).mapInArrow(_derive_text, GRAPH)
    return derived.select(F.col("capture_id").alias("workflow"), "format", "workflow_id", "canonical_hash", "structural_hash")


def _derive_meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for capture, meta in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held = decode_object(meta)
            for _, path, graph in graphs(held) if held is not None else ():
                rows.append([*_graph_row(derive(graph)), capture, path])
        yield _graph_batch(rows)


@query()
def captured_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every graph in any source_meta derived: its identities and counts."""
    return table(spark, sf_dir, "raw_artifacts").select("capture_id", "source_meta").filter("source_meta IS NOT NULL").mapInArrow(_derive_meta, GRAPH)


@query()
def structural_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graphs that are one topology, with the number of identities of each kind in them."""
    return captured_graphs(spark, sf_dir).filter("format <> 'unknown'").groupBy("structural_hash").agg(
        F.count(F.lit(1)).alias("graphs"), F.count_distinct("workflow_id").alias("workflows"), F.count_distinct("canonical_hash").alias("canonical")
    )


# --- plain SQL ----------------------------------------------------------------------------

PRICING = """
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"""
REGIONS = """
SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, round(sum(o_totalprice), 2) AS total
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
GROUP BY r_name, n_name"""
TOP_PARTS = """
SELECT p_brand, p_partkey, revenue FROM (
  SELECT p_brand, p_partkey, revenue, row_number() OVER (PARTITION BY p_brand ORDER BY revenue DESC, p_partkey) AS n FROM (
    SELECT p_brand, p_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand, p_partkey) a) b
WHERE n <= 3"""


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


@query(PRICING)
def sql_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query surface (S20): an aggregate over one large table."""
    return _sql(spark, sf_dir, PRICING, "lineitem")


@query(REGIONS)
def sql_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query surface (S20): a star join."""
    return _sql(spark, sf_dir, REGIONS, "region", "nation", "customer", "orders")


@query(TOP_PARTS)
def sql_top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query surface (S20): the best three of each group."""
    return _sql(spark, sf_dir, TOP_PARTS, "lineitem", "part")
