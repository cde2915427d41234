"""Jobs that find and capture artifacts: from recorded pages and stored files to manifests.

Servers are stood in for by tables: listing pages by ``sources.pages``, files by (artifact_id,
content) and what else is known of each answer, generation records by (artifact_id, status, body).
Each job takes the time it runs at, asks the gate first and stores what it made before it marks
work as done.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.ranges import capture_file, wants_api
from graphloom.functions.text import host
from graphloom.operators import health, listing, queue
from graphloom.operators.state import absent, upsert
from graphloom.schemas import CRAWLER_VERSION, MANIFEST, PARSER_VERSION
from graphloom.sources.manifests import blob_rows, drop_blobs, write_blobs, write_manifest
from graphloom.sources.pages import generation_documents, lookup_records
from graphloom.sources.shared import materialize
from graphloom.sources.store import StateStore

TIP_PAGES, TIP_PRIORITY, BACKLOG_PRIORITY, KEEP_PREFIX_DAYS = 40, 10, 1, 30
#: Fixed value: how a bare file id becomes an address; a parameter of the jobs.
FILE_URL = "https://files.example/{id}/original=true/{name}"

CAPTURED = (
    "artifact_id string, url string, container string, channel string, total_size bigint, bytes_fetched bigint, needed_bytes bigint, "
    "windows array<bigint>, from_tail boolean, workflow string, prompt string, prefix binary, late boolean"
)
#: The host of generation records, and what stands for their address in a manifest.
API_HOST, API_URL = "api.example", "generation record"
#: Tries of a request that may be worth another one.
MOST_TRIES = 3


class Latched(RuntimeError):
    """A host refused again and again; someone has to look."""


class BackingOff(RuntimeError):
    """A host failed again and again; it is left alone for a while."""


def at(now: dt.datetime) -> Column:
    return F.lit(now).cast("timestamp")


def check_gate(store: StateStore, hosts: DataFrame, now: dt.datetime) -> None:
    """Raise if one of the hosts (host) is latched, or else if one is backing off. All of them are asked
    about; an error names a hundred."""
    log, status = store.read("requests"), F.col("status")
    by_hour = F.date_trunc("hour", "ts")
    latched = health.latches(log, "host", ["ts"], health.refused(status), health.succeeded(status), slices=by_hour)
    active = health.active_latches(latched, store.read("clears"), "host", "ts", "cleared_at")
    # a host is waiting if its last failure counts and no success came after it
    waits = health.backoffs(log, "host", ["ts"], health.transient(status), health.succeeded(status), slices=by_hour)
    fine = log.filter(health.succeeded(status)).groupBy("host").agg(F.max("ts").alias("fine"))
    waits = waits.filter("seconds > 0").withColumn("until", F.col("ts") + F.make_interval(secs=F.col("seconds"))).join(fine, "host", "left")
    waits = waits.filter(F.col("fine").isNull() | (F.col("fine") < F.col("ts")))
    verdicts = materialize(health.gate(hosts.filter(F.col("host").isNotNull()), active, waits, "host", "until", at(now)).filter("verdict <> 'open'"), "verdicts")
    for kind, error in (("latched", Latched), ("backing_off", BackingOff)):
        stopped = [r["host"] for r in verdicts.filter(F.col("verdict") == kind).orderBy("host").limit(100).collect()]
        if stopped:
            raise error(", ".join(stopped))


def queue_rows(items: DataFrame, source: str, priority: int, url: str = FILE_URL) -> DataFrame:
    """Listing items as rows of the queue, with their place in the listing."""
    return items.select(
        F.lit(source).alias("source"), "artifact_id", "post_id", "author_id", F.try_to_timestamp("published_at").alias("published_at"),
        F.lit(priority).alias("priority"), F.lit("pending").alias("state"), F.lit(None).cast("timestamp").alias("lease_until"), F.lit(0).alias("attempts"),
        F.lit(None).cast("string").alias("last_error"), listing.absolute_url(F.col("url"), F.col("name"), url).alias("url"), "has_meta",
        F.struct("page", "position").alias("place"),
    )


def _fresh(items: DataFrame, held: DataFrame, source: str, mode: str, one_per_post: bool, priority: int) -> DataFrame:
    """Items that would really be put into the queue, each at the first place it is listed."""
    wanted = queue_rows(items.filter(listing.wanted(F.col("tool_ids"), F.col("has_meta"), mode)), source, priority)
    others = [c for c in wanted.columns if c not in ("source", "artifact_id")]
    first = wanted.groupBy("source", "artifact_id").agg(F.min_by(F.struct(*others), "place").alias("r")).select("source", "artifact_id", "r.*")
    kept = queue.one_per_post(first, held, "place") if one_per_post else first
    return kept.join(held.select("source", "artifact_id"), ["source", "artifact_id"], "left_anti")


def discover_tip(
    store: StateStore, pages: DataFrame, source: str, now: dt.datetime, mode: str = "complete", max_pages: int = TIP_PAGES, one_per_post: bool = True
) -> dict:
    """Queue what the newest pages have, up to two pages in a row without anything new."""
    items = materialize(pages.filter((F.col("stream") == "tip") & (F.col("page") < max_pages) & F.col("artifact_id").isNotNull()), "tip")
    held = store.read("queue")
    fresh = materialize(_fresh(items, held, source, mode, one_per_post, TIP_PRIORITY), "fresh")
    per_page = items.select("page").distinct().join(fresh.groupBy(F.col("place.page").alias("page")).agg(F.count(F.lit(1)).alias("n")), "page", "left")
    read = materialize(health.until_dry(per_page.select("page", F.coalesce("n", F.lit(0)).alias("new_rows")), "page", "new_rows"), "read")
    seen = items.join(read.select("page"), "page", "left_semi")
    queued = fresh.filter(F.col("place.page").isin([r["page"] for r in read.select("page").collect()])).drop("place")  # at most max_pages
    n = queued.count()
    users = seen.filter("author_id IS NOT NULL").select(F.lit(source).alias("source"), F.lit("user").alias("kind"), F.col("author_id").alias("key")).distinct()
    new_users = materialize(absent(users, store.read("partitions"), ["source", "kind", "key"]).withColumns({"exhausted": F.lit(False), "discovered_at": at(now)}), "users")
    newest = seen.agg(F.max(F.expr("try_cast(artifact_id AS bigint)")).cast("string").alias("id"), F.max("published_at").alias("published")).head()
    store.append("queue", queued)
    store.append("partitions", new_users)
    cursor = store.spark.createDataFrame([(source, "tip", None, newest["id"], now)], "source string, stream string, cursor string, frontier_id string, updated_at timestamp")
    store.write("cursors", materialize(upsert(store.read("cursors"), cursor, ["source", "stream"], ["frontier_id"]), "cursors"))
    last = [r["new_rows"] for r in read.orderBy("page").collect()][-2:]
    return {
        "pages": read.count(), "queued": n, "new_partitions": new_users.count(), "frontier_id": newest["id"], "newest_published": newest["published"],
        "caught_up": last == [0, 0],
    }


def discover_backlog(
    store: StateStore, pages: DataFrame, source: str, now: dt.datetime, mode: str = "tagged", partitions: int = 5, max_pages: int = TIP_PAGES, one_per_post: bool = True
) -> dict:
    """Read up to ``max_pages`` further pages of the users swept longest ago."""
    done = exhausted = queued = 0
    for _ in range(partitions):
        claimed, leased = queue.claim_partition(store.read("partitions"), source, "user", at(now))
        row = claimed.head()
        if row is None:
            break
        store.write("partitions", materialize(leased, "partitions"))
        start = int(row["cursor"] or 0)
        own = pages.filter((F.col("stream") == f"user-{row['key']}") & F.col("artifact_id").isNotNull())
        items = materialize(own.filter(F.col("page").between(start, start + max_pages - 1)), "backlog")
        more = not own.filter(F.col("page") >= start + max_pages).isEmpty()
        fresh = materialize(_fresh(items, store.read("queue"), source, mode, one_per_post, BACKLOG_PRIORITY).drop("place"), "fresh")
        store.append("queue", fresh)
        read = items.select("page").distinct().count()
        update = store.spark.createDataFrame(
            [(source, "user", row["key"], str(start + read) if more else None, not more, now, (row["pages_read"] or 0) + read, (row["images_seen"] or 0) + items.count(), None)],
            "source string, kind string, key string, cursor string, exhausted boolean, swept_at timestamp, pages_read bigint, images_seen bigint, lease_until timestamp",
        )
        store.write("partitions", materialize(queue.update(store.read("partitions"), update, ["source", "kind", "key"]), "partitions"))
        done, exhausted, queued = done + 1, exhausted + (not more), queued + fresh.count()
    return {"drained": done, "exhausted": exhausted, "queued": queued}


def _capturing(stop_at: float | None):
    """Captures files until a time of the clock; those after it come back unread and marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.string(), pa.string(), pa.binary(), pa.bool_()]
        names = [c.split()[0] for c in CAPTURED.split(", ")]
        for batch in batches:
            rows = []
            for artifact, url, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stop_at is not None and time.time() >= stop_at:
                    rows.append((artifact, url, None, "", 0, 0, None, [], False, None, None, None, True))
                    continue
                got = capture_file(content)
                prefix = content[-(128 * 1024) :] if got.from_tail else content[: sum(got.windows)]
                rows.append((
                    artifact, url, got.container, got.channel, got.total_size, got.bytes_fetched, got.needed_bytes, got.windows, got.from_tail, got.workflow, got.prompt, prefix,
                    False,
                ))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def manifest_rows(captured: DataFrame, items: DataFrame, source: str, run_id: str, now: dt.datetime) -> DataFrame:
    """Manifest lines of captures of one channel: one for each document found, one without if none was."""
    found = F.filter(
        F.array(F.struct(F.lit("workflow").alias("kind"), F.col("workflow").alias("text")), F.struct(F.lit("prompt").alias("kind"), F.col("prompt").alias("text"))),
        lambda d: d["text"].isNotNull(),
    )
    none = F.array(F.struct(F.lit("none").alias("kind"), F.lit(None).cast("string").alias("text")))
    each = captured.join(items.select("artifact_id", "author_id", "published_at"), "artifact_id").withColumn(
        "doc", F.explode(F.when(F.size(found) > 0, found).otherwise(none))
    )
    values = {
        "capture_id": F.concat_ws(":", F.lit(source), "artifact_id", "channel", "doc.kind"), "crawled_at": F.lit(now.strftime("%Y-%m-%dT%H:%M:%S+00:00")),
        "crawler_version": F.lit(CRAWLER_VERSION), "parser_version": F.lit(PARSER_VERSION), "run_id": F.lit(run_id), "source": F.lit(source), "channel": F.col("channel"),
        "source_artifact_id": F.col("artifact_id"), "fetch_url": F.col("url"), "author_id": F.coalesce("author_id", F.lit("")),
        "published_at": F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "http_status": F.col("status"), "container": F.coalesce("container", F.lit("")),
        "total_size": F.col("total_size"), "needed_bytes": F.col("needed_bytes"), "bytes_fetched": F.col("bytes_fetched"), "windows": F.col("windows"),
        "from_tail": F.col("from_tail"), "payload_kind": F.col("doc.kind"), "payload_sha256": F.sha2(F.encode("doc.text", "UTF-8"), 256),
        "payload_bytes": F.coalesce(F.octet_length("doc.text"), F.lit(0)).cast("long"), "prefix_sha256": F.sha2("prefix", 256),
    }
    fields = [(c.split()[0], c.split(maxsplit=1)[1]) for c in MANIFEST.split(", ")]
    return each.select(*[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def settled(answers: DataFrame) -> DataFrame:
    """Of several recorded tries (artifact_id, status, attempt) of a request the one that ends it, the
    first that is neither 429 nor an error of the server, or else the last of MOST_TRIES; with
    ``refusals``, how many tries up to it were refused. Later tries were never made."""
    order = Window.partitionBy("artifact_id").orderBy("attempt")
    tries = answers.withColumn("_try", F.row_number().over(order)).filter(F.col("_try") <= MOST_TRIES)  # a few rows an artifact
    again = (F.col("status") == 429) | health.transient(F.col("status"))
    first = F.min(F.when(~again, F.col("_try"))).over(Window.partitionBy("artifact_id"))
    last = F.coalesce(first, F.max("_try").over(Window.partitionBy("artifact_id")))
    refusals = F.sum(health.refused(F.col("status")).cast("int")).over(order)
    return tries.withColumns({"_last": last, "refusals": refusals}).filter(F.col("_try") == F.col("_last")).drop("_try", "_last")


def paced(requests: DataFrame, key: str, order: list[str], gap_seconds: float, wait: Column) -> DataFrame:
    """``requests`` with ``starts_after``: seconds after the first of its ``key`` at which each may begin,
    so that two are never closer than the gap, nor closer than the ``wait`` that the former asks for."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return requests.withColumn("starts_after", F.coalesce(F.sum(F.greatest(F.lit(gap_seconds), F.coalesce(wait, F.lit(0.0)))).over(before), F.lit(0.0)))


def _answers(files: DataFrame) -> DataFrame:
    """Files with the status of their answer (206 where it is not recorded), one row an artifact."""
    full = files if "status" in files.columns else files.withColumn("status", F.lit(206))
    if "attempt" in files.columns:
        full = settled(full)
    return full.select("artifact_id", "content", "status", *(["refusals"] if "refusals" in full.columns else []))


def fetch(
    store: StateStore, files: DataFrame, source: str, out: str, now: dt.datetime, batch: int = 200, keep_prefix: bool = True,
    deadline: dt.datetime | None = None, api: DataFrame | None = None,
) -> dict:
    """Capture a batch of queued artifacts from ``files`` into manifests below ``out`` and blobs.

    Artifacts without a file are gone and are marked so; a barren file outside the sample is skipped
    unread; an error of the server fails its artifact. What was refused, and what was not begun by
    the deadline, which is asked about before each file, is given back. If ``api`` is given, artifacts
    of which the listing says that there is a graph, and whose file had none, are looked up there; what
    is found is a capture of its own, behind that of the bytes. Manifest and blobs are stored before
    the queue says done; every answer goes into the log, and if a host is latched by that the batch
    ends with Latched.
    """
    stop_at = None if deadline is None else time.time() + (deadline - now).total_seconds()
    claimed, leased = queue.claim(store.read("queue"), source, batch, at(now))
    items = materialize(claimed, "claimed")
    if items.isEmpty():
        return {"claimed": 0, "captured": 0, "gone": 0, "skipped": 0, "failed": 0, "refused": 0, "with_payload": 0, "from_api": 0, "bytes_down": 0, "released": 0}
    hosts = items.select(host("url").alias("host")).distinct()
    check_gate(store, hosts, now)
    store.write("queue", materialize(leased, "queue"))
    run_id = str(uuid.uuid4())
    here = items.join(_answers(files), "artifact_id", "left").withColumn("worth", F.coalesce(listing.worth_fetching(F.col("url")), F.lit(False)))
    status = F.coalesce("status", F.lit(404))
    fine = F.col("content").isNotNull() & health.succeeded(status)
    here = materialize(here.withColumns({"status": status, "fine": fine}), "here")
    tried = here.filter("worth")
    captured = tried.filter("fine").select("artifact_id", "url", "content").mapInArrow(_capturing(stop_at), CAPTURED)
    captured = materialize(captured.join(tried.select("artifact_id", "status"), "artifact_id"), "captured")
    late, captured = captured.filter("late").select("artifact_id"), captured.filter("NOT late")
    lines = manifest_rows(captured, items, source, run_id, now)
    documents = captured.select("artifact_id", "workflow", "prompt")
    looked = None
    if api is not None:
        asked = captured.filter("workflow IS NULL").select("artifact_id").join(items.filter(wants_api(None, F.col("has_meta"))).select("artifact_id"), "artifact_id")
        looked = materialize(lookup_records(asked.distinct(), api), "looked")
        answered = materialize(generation_documents(looked.filter("record IS NOT NULL")).filter("workflow IS NOT NULL OR prompt IS NOT NULL"), "answered")
        columns = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split(maxsplit=1) for c in CAPTURED.split(", ")) if name not in ("artifact_id", "url", "channel", "workflow", "prompt")]
        records = answered.select("artifact_id", F.lit(API_URL).alias("url"), F.lit("api").alias("channel"), "workflow", "prompt", *columns, F.lit(200).alias("status"))
        # an artifact with a graph from the record needs no line that says there is none
        found = lines.join(answered.select(F.col("artifact_id").alias("source_artifact_id")), "source_artifact_id", "left_semi").filter("payload_kind = 'none'")
        lines = lines.join(found.select("capture_id"), "capture_id", "left_anti").select(*lines.columns).unionByName(manifest_rows(records, items, source, run_id, now))
        documents = documents.unionByName(answered)
    lines = materialize(lines, "lines")
    write_manifest(lines.drop("manifest_key", "line"), f"{out.rstrip('/')}/raw/{source}/{now:%Y-%m}")
    pieces = documents.select(F.explode(F.array(
        F.struct(F.encode("workflow", "UTF-8").alias("content"), F.lit("workflow").alias("kind")), F.struct(F.encode("prompt", "UTF-8").alias("content"), F.lit("prompt").alias("kind")),
    )).alias("p")).select("p.content", "p.kind")
    if keep_prefix:
        pieces = pieces.unionByName(captured.select(F.col("prefix").alias("content"), F.lit("prefix").alias("kind")))
    stored = materialize(write_blobs(pieces, out), "stored")
    store.append("blobs", blob_rows(stored, store.read("blobs").select("sha256", "kind_class"), KEEP_PREFIX_DAYS, at(now)))
    # stored: from here on work may be marked as done
    kind = lambda state, error: F.struct(F.lit(state).alias("state"), error.cast("string").alias("error"))
    answer = F.concat(F.lit("HTTP "), F.col("status").cast("string"))
    state = (
        F.when(~F.col("worth"), kind("skipped", F.lit("barren"))).when(F.col("fine"), kind("done", F.lit(None)))
        .when(F.col("status").isin(*health.REFUSALS), kind("refused", answer)).when(F.col("status") >= 500, kind("failed", answer))
        .otherwise(kind("skipped", F.lit("gone")))
    )
    outcomes = materialize(here.join(late, "artifact_id", "left_anti").select("source", "artifact_id", state.alias("o")).select("source", "artifact_id", "o.*"), "outcomes")
    ended = outcomes.filter("state <> 'refused'")
    after = queue.finish(store.read("queue"), ended)
    back = materialize(queue.unprocessed(items, ended, ended.select("source", "artifact_id").limit(0)), "back")
    store.write("queue", materialize(queue.release(after, back), "queue"))
    log = _request_log(tried.join(late, "artifact_id", "left_anti"), looked, now)
    store.append("requests", log)
    sums = captured.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes_fetched"), F.lit(0)).alias("b")).head()
    counts = {(r["state"], r["error"]): r["n"] for r in outcomes.groupBy("state", "error").agg(F.count(F.lit(1)).alias("n")).collect()}  # a few kinds
    total = lambda *keys: sum(n for (state, error), n in counts.items() if state in keys or error in keys)
    result = {
        "claimed": items.count(), "captured": sums["n"], "gone": total("gone"), "skipped": total("barren"), "failed": total("failed"), "refused": total("refused"),
        "with_payload": lines.filter("payload_kind <> 'none'").select("source_artifact_id").distinct().count(),
        "from_api": lines.filter("channel = 'api'").select("source_artifact_id").distinct().count(), "bytes_down": sums["b"], "released": back.count(),
    }
    if result["refused"] or looked is not None:
        with_api = hosts.unionByName(store.spark.createDataFrame([(API_HOST,)], "host string")) if looked is not None else hosts
        try:
            check_gate(store, with_api, now + dt.timedelta(seconds=1))
        except BackingOff:
            pass  # the next batch will see it; this one is over
    return result


def _request_log(tried: DataFrame, looked: DataFrame | None, now: dt.datetime) -> DataFrame:
    """(host, ts, status) of the answers of a batch, in the order of the queue: each try that was refused,
    then the answer itself. Times within a batch differ by microseconds, to keep that order."""
    refusals = F.coalesce("refusals", F.lit(0)) if "refusals" in tried.columns else F.lit(0)
    refused = F.col("status").isin(*health.REFUSALS).cast("int")
    each = tried.select(
        host("url").alias("host"), "priority", F.col("published_at").alias("published"), "artifact_id",
        F.posexplode(F.concat(F.array_repeat(F.lit(429), F.greatest(refusals - refused, F.lit(0))), F.array("status"))).alias("n", "status"),
    )
    if looked is not None:
        each = each.unionByName(looked.select(
            F.lit(API_HOST).alias("host"), F.lit(0).alias("priority"), F.lit(None).cast("timestamp").alias("published"), "artifact_id", F.lit(0).alias("n"), "status"
        ))
    # a batch of the queue, not the queue
    order = Window.orderBy(F.desc("priority"), F.desc_nulls_last("published"), "artifact_id", "n")
    since = F.make_interval(secs=F.row_number().over(order) * F.lit(1e-6))
    return each.filter("host IS NOT NULL").withColumn("since", since).select("host", (at(now) + F.col("since")).alias("ts"), "status")


def collect_garbage(store: StateStore, out: str, now: dt.datetime, limit: int = 1000) -> dict:
    """Drop expired byte prefixes, the oldest ``limit`` of them: the objects below ``out`` first, then
    their rows, so that none is forgotten and left behind."""
    blobs = store.read("blobs")
    past = materialize(queue.expired(blobs, at(now), limit).select("sha256", "kind_class", "kind"), "past")
    drop_blobs(past, out)
    store.write("blobs", materialize(blobs.join(past, ["sha256", "kind_class"], "left_anti"), "blobs"))
    return {"prefixes_removed": past.count()}


def unlatch(store: StateStore, name: str, by: str, now: dt.datetime) -> dict:
    """Clear a host's latch; only people do that."""
    status = F.col("status")
    latched = health.latches(store.read("requests"), "host", ["ts"], health.refused(status), health.succeeded(status), slices=F.date_trunc("hour", "ts"))
    held = health.active_latches(latched, store.read("clears"), "host", "ts", "cleared_at").filter(F.col("host") == name)
    cleared = not held.isEmpty()
    if cleared:
        store.append("clears", store.spark.createDataFrame([(name, now, by)], "host string, cleared_at timestamp, cleared_by string"))
    return {"host": name, "cleared": cleared, "by": by}


def status(store: StateStore, source: str) -> dict:
    """Latches first, for a latched crawler looks healthy by all else; then queue, partitions, cursor."""
    code = F.col("status")
    latched = health.latches(store.read("requests"), "host", ["ts"], health.refused(code), health.succeeded(code), slices=F.date_trunc("hour", "ts"))
    active = health.active_latches(latched, store.read("clears"), "host", "ts", "cleared_at").orderBy("ts").limit(1000).collect()
    kinds = queue.partition_stats(store.read("partitions").filter(F.col("source") == source)).collect()
    cursor = store.read("cursors").filter((F.col("source") == source) & (F.col("stream") == "tip")).head()
    return {
        "latched": [{"host": r["host"], "since": str(r["ts"]), "status": r["status"], "consecutive": r["streak"]} for r in active] or None,
        "queue": {r["state"]: r["n"] for r in queue.queue_stats(store.read("queue").filter(F.col("source") == source)).collect()},
        "partitions": {f"{r['kind']}_{what}": r[what] for r in kinds for what in ("exhausted", "pending")},
        "tip_cursor": cursor["frontier_id"] if cursor else None,
    }
