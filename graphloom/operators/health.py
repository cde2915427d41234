"""Streaks in ordered request logs: sticky latches, self-clearing backoff, dry pages.

Three classes of outcome: a refusal counts up, a success starts anew, anything else does
neither. A host's log may be cut into slices of time: each is one task's work, and what a
streak carries from slice to slice is worked out on one row a slice. So a host with a third
of all requests is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import backoff_seconds

REFUSALS = (401, 403, 429)
LATCH_AT = 3
BACKOFF_AT, BACKOFF_BASE = 3, 900


def refused(status: Column) -> Column:
    return status.isin(*REFUSALS)


def succeeded(status: Column) -> Column:
    return status < 400


def transient(status: Column) -> Column:
    return status >= 500


def streaks(log: DataFrame, host: str, order: list[str], counts: Column, resets: Column, slices: Column | None = None) -> DataFrame:
    """Rows of ``log`` that count, with ``streak``: how many of them came since the last reset.
    Rows with a null outcome neither count nor reset. ``slices`` must not fall where ``order``
    rises, as the hour of its time does; without it a host is one slice."""
    key = [host, "_slice"]
    upto = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = log.withColumns({
        "_counts": F.coalesce(counts, F.lit(False)), "_resets": F.coalesce(resets, F.lit(False)), "_slice": F.lit(0) if slices is None else slices,
    })
    runs = marked.filter("_counts OR _resets").withColumn("_run", F.sum(F.col("_resets").cast("long")).over(upto))
    in_run = Window.partitionBy(*key, "_run").orderBy(*order)
    local = runs.filter("_counts").withColumn("streak", F.row_number().over(in_run))
    if slices is None:
        return local.drop("_counts", "_resets", "_run", "_slice")
    # a slice hands on the streak it ends with; one without a reset adds it to what it was handed
    ends = runs.groupBy(*key, "_run").agg(F.count_if("_counts").alias("c")).groupBy(*key).agg(F.max_by("c", "_run").alias("tail"), F.max("_run").alias("resets"))
    by_slice = Window.partitionBy(host).orderBy("_slice")
    chained = ends.withColumn("_chain", F.sum((F.col("resets") > 0).cast("int")).over(by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    in_chain = Window.partitionBy(host, "_chain").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    handed = chained.withColumn("_end", F.sum("tail").over(in_chain)).select(*key, F.coalesce(F.lag("_end").over(by_slice), F.lit(0)).alias("_carry"))
    whole = F.col("streak") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(F.lit(0))
    return local.join(handed, key).withColumn("streak", whole).drop("_counts", "_resets", "_run", "_slice", "_carry")


def latches(
    log: DataFrame, host: str, order: list[str], counts: Column, resets: Column, threshold: int = LATCH_AT, slices: Column | None = None
) -> DataFrame:
    """The first row of each host at which a streak reaches the threshold. A latch is sticky: later
    successes do not take it back."""
    reached = streaks(log, host, order, counts, resets, slices).filter(F.col("streak") >= threshold)
    others = [c for c in reached.columns if c != host]
    return reached.groupBy(host).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first")).select(host, "_first.*").select(*reached.columns)


def active_latches(latched: DataFrame, cleared: DataFrame, host: str, at: str, cleared_at: str) -> DataFrame:
    """Latches that no one cleared at or after their time; a host cleared once can latch again."""
    last = cleared.groupBy(host).agg(F.max(cleared_at).alias("_cleared"))
    return latched.join(last, host, "left").filter(F.col("_cleared").isNull() | (F.col("_cleared") < F.col(at))).drop("_cleared")


def backoffs(
    log: DataFrame, host: str, order: list[str], counts: Column, resets: Column, threshold: int = BACKOFF_AT, base: int = BACKOFF_BASE,
    slices: Column | None = None,
) -> DataFrame:
    """Streak rows with ``seconds``: how long the host is left alone after each."""
    return streaks(log, host, order, counts, resets, slices).withColumn("seconds", backoff_seconds(F.col("streak"), threshold, base))


def gate(hosts: DataFrame, latched: DataFrame, waiting: DataFrame, host: str, until: str, now: Column) -> DataFrame:
    """(host, verdict): latched comes before backing_off, else open."""
    held = latched.select(host, F.lit(True).alias("_l")).distinct()
    later = waiting.filter(F.col(until) > now).select(host, F.lit(True).alias("_w")).distinct()
    verdict = F.when(F.col("_l"), "latched").when(F.col("_w"), "backing_off").otherwise("open")
    return hosts.select(host).distinct().join(held, host, "left").join(later, host, "left").select(host, verdict.alias("verdict"))


def until_dry(pages: DataFrame, order: str, new_rows: str, stop_after: int = 2, stream: str | None = None) -> DataFrame:
    """Pages up to and with the one that makes ``stop_after`` in a row without new rows. ``order`` is the
    number of a page; a number that is missing ends a row of dry ones. Pages of a ``stream`` are
    counted within it; without one all pages are one stream, as a tip sweep is.

    Each dry page counts towards the ends it can be part of, so a stream of any length is no single
    task.
    """
    key = [stream] if stream else []
    number = F.col(order).cast("long")
    dry = pages.filter(F.coalesce(F.col(new_rows), F.lit(0)) <= 0).select(*key, F.explode(F.sequence(number, number + stop_after - 1)).alias("_end")).groupBy(*key, "_end").agg(F.count(F.lit(1)).alias("_n"))
    ends = dry.filter(F.col("_n") >= stop_after)
    if not stream:
        stop = ends.agg(F.min("_end").alias("stop")).head()["stop"]
        return pages if stop is None else pages.filter(number <= stop)
    stops = ends.groupBy(stream).agg(F.min("_end").alias("_stop"))
    return pages.join(stops, stream, "left").filter(F.col("_stop").isNull() | (number <= F.col("_stop"))).drop("_stop")
