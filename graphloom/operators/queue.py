"""The work queue as state rows: claiming with leases, finishing, releasing, partitions.

Every function takes the time it is judged at, so results do not depend on the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import error_text
from graphloom.operators.state import absent, update

HELD_STATES = ("done", "leased", "pending")


def claimable(now: Column) -> Column:
    return (F.col("state") == "pending") | ((F.col("state") == "leased") & (F.col("lease_until") < now))


def claim(queue: DataFrame, source: str, n: int, now: Column, lease_seconds: int = 900) -> tuple[DataFrame, DataFrame]:
    """(claimed, queue after): up to ``n`` rows of a source, of the highest priority and then the
    latest publication, nulls last; artifact_id decides between equals."""
    order = [F.desc("priority"), F.desc_nulls_last("published_at"), F.asc("artifact_id")]
    picked = queue.filter((F.col("source") == source) & claimable(now)).orderBy(*order).limit(n)
    claimed = picked.withColumns({
        "state": F.lit("leased"), "lease_until": now + F.make_interval(secs=F.lit(lease_seconds)), "attempts": F.coalesce("attempts", F.lit(0)) + 1,
    })
    return claimed, update(queue, claimed.select("source", "artifact_id", "state", "lease_until", "attempts"), ["source", "artifact_id"])


def seconds_left(until: Column, now: Column) -> Column:
    """Whole seconds up to a time, null for one that is past or null."""
    left = F.unix_micros(until) - F.unix_micros(now)
    return F.when(left > 0, F.floor(left / 1_000_000))


def finish(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Set state and error of (source, artifact_id, state, error) and end the lease."""
    done = outcomes.select("source", "artifact_id", "state", F.lit(None).cast("timestamp").alias("lease_until"), error_text("error").alias("last_error"))
    return update(queue, done, ["source", "artifact_id"])


def release(queue: DataFrame, ids: DataFrame) -> DataFrame:
    """Give leases back; rows of (source, artifact_id) that are not leased stay as they are."""
    leased = queue.filter("state = 'leased'").join(ids.select("source", "artifact_id").distinct(), ["source", "artifact_id"], "left_semi")
    freed = leased.select("source", "artifact_id", F.lit("pending").alias("state"), F.lit(None).cast("timestamp").alias("lease_until"))
    return update(queue, freed, ["source", "artifact_id"])


def unprocessed(claimed: DataFrame, processed: DataFrame, undurable: DataFrame) -> DataFrame:
    """Leases to give back at the end of a run: what was not processed, and what was without its
    record being stored."""
    key = ["source", "artifact_id"]
    return claimed.select(*key).join(processed.select(*key), key, "left_anti").unionByName(undurable.select(*key)).distinct()


def enqueue(queue: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(really new rows, queue after)."""
    fresh = absent(items, queue, ["source", "artifact_id"])
    return fresh, queue.unionByName(fresh, allowMissingColumns=True)


def one_per_post(items: DataFrame, queue: DataFrame, position: str) -> DataFrame:
    """The first listed item of each post that is not held yet; items without a post are all kept.

    The least position is a partial aggregate, so a post with a third of all items is no burden.
    """
    posted = items.filter(F.col("post_id").isNotNull())
    others = [c for c in items.columns if c not in ("source", "post_id")]
    first = posted.groupBy("source", "post_id").agg(F.min_by(F.struct(*others), F.struct(position, "artifact_id")).alias("_row")).select("source", "post_id", "_row.*")
    held = queue.filter(F.col("state").isin(*HELD_STATES) & F.col("post_id").isNotNull()).select("source", "post_id").distinct()
    return items.filter(F.col("post_id").isNull()).unionByName(first.join(held, ["source", "post_id"], "left_anti"))


def queue_stats(queue: DataFrame) -> DataFrame:
    return queue.groupBy("source", "state").agg(F.count(F.lit(1)).alias("n"))


def partition_stats(partitions: DataFrame) -> DataFrame:
    return partitions.groupBy("source", "kind").agg(
        F.count_if("exhausted").alias("exhausted"), F.count_if(~F.coalesce("exhausted", F.lit(False))).alias("pending")
    )


def claim_partition(partitions: DataFrame, source: str, kind: str, now: Column, lease_seconds: int = 1800) -> tuple[DataFrame, DataFrame]:
    """(claimed, partitions after): the one swept longest ago, never swept ones first."""
    free = F.col("lease_until").isNull() | (F.col("lease_until") < now)
    wanted = (F.col("source") == source) & (F.col("kind") == kind) & ~F.coalesce("exhausted", F.lit(False)) & free
    key = ["source", "kind", "key"]
    taken = partitions.filter(wanted).orderBy(F.asc_nulls_first("swept_at"), "discovered_at", "key").limit(1)
    taken = taken.withColumn("lease_until", now + F.make_interval(secs=F.lit(lease_seconds)))
    return taken, update(partitions, taken.select(*key, "lease_until"), key)


def expired(blobs: DataFrame, now: Column, n: int | None = None) -> DataFrame:
    """Blobs past their time, the oldest first if there is a limit."""
    past = blobs.filter(F.col("expires_at").isNotNull() & (F.col("expires_at") < now))
    return past.orderBy("expires_at", "sha256").limit(n) if n is not None else past


def per_key_rank(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """Rank by an order that keeps equal rows in the order given, from 0."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)
