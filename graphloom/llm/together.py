"""P6. Items that appear together, by stripes.

Only items in at least as many records as a pair must have can be part of such a pair; with
the least support tied to the number of records, the items left are at most
``records / least`` times the mean number of items of a record, whatever the size of the
data. They get numbers. Each task then adds up, for each item, an array of the items after it
and how often each came along (its stripe), cut into blocks of neighbours, so that a stripe of an
item that stands beside all others is many pieces. Stripes travel as arrays to the task of their
item and block and are merged there; pairs of single records are never sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.skew import replicated
from graphloom.sources.shared import materialize

STRIPES = "item_kind string, a int, block int, neighbours array<int>, counts array<int>"
#: Numbers of neighbours in one piece of a stripe, as a power of two.
BLOCK_BITS = 12
#: Ratio from which a pair is no chance: 0.1 % of the chi-square distribution with one degree.
SIGNIFICANT = 10.828
#: Pair codes that a task gathers before it adds them up.
GATHER = 2_000_000
#: Up to so many numbered items go to every task; more are joined by salted copies.
BROADCAST_ITEMS = 500_000


def _reduce(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, number = np.concatenate(codes), np.concatenate(counts)
    unique, at = np.unique(every, return_inverse=True)
    return unique, np.bincount(at, weights=number, minlength=len(unique)).astype(np.int64)


def _stripes(kind: str, codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    piece = codes >> BLOCK_BITS  # item and block of the neighbour
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    offsets = pa.array(np.r_[starts, len(codes)].astype(np.int32))
    head = codes[starts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(starts), pa.string()), pa.array((head >> 32).astype(np.int32)),
            pa.array(((head & 0xFFFFFFFF) >> BLOCK_BITS).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array((codes & 0xFFFFFFFF).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
        ],
        names=["item_kind", "a", "block", "neighbours", "counts"],
    )


def _stripe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes: dict[str, list[np.ndarray]] = {}
    counts: dict[str, list[np.ndarray]] = {}
    waiting: dict[str, int] = {}
    held: dict[str, int] = {}

    def squash(kind: str) -> None:
        code, number = _reduce(codes[kind], counts[kind])
        codes[kind], counts[kind], waiting[kind], held[kind] = [code], [number], 0, len(code)

    for batch in batches:
        for kind, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.sort(np.asarray(items, dtype=np.int64))
            for at in range(0, len(own) - 1):
                pairs = (own[at] << 32) | own[at + 1 :]
                codes.setdefault(kind, []).append(pairs)
                counts.setdefault(kind, []).append(np.ones(len(pairs), dtype=np.int64))
                waiting[kind] = waiting.get(kind, 0) + len(pairs)
                if waiting[kind] >= GATHER:
                    squash(kind)
                    if held[kind] >= GATHER:
                        yield _stripes(kind, codes[kind][0], counts[kind][0])
                        codes[kind], counts[kind], held[kind] = [], [], 0
    for kind in codes:
        if codes[kind]:
            squash(kind)
            yield _stripes(kind, codes[kind][0], counts[kind][0])


def log_likelihood(both: Column, a: Column, b: Column, n: Column) -> Column:
    """Dunning's ratio (G squared) of the two-by-two table of two items in n records."""
    def part(k: Column, row: Column, column: Column) -> Column:
        return F.when(k > 0, k * F.log(k * n / (row * column))).otherwise(F.lit(0.0))

    k11, k12, k21, k22 = (c.cast("double") for c in (both, a - both, b - both, n - a - b + both))
    a, b, n = a.cast("double"), b.cast("double"), n.cast("double")
    return 2 * (part(k11, a, b) + part(k12, a, n - b) + part(k21, n - a, b) + part(k22, n - a, n - b))


def pairs(rows: DataFrame, records: int, least: int = 12, least_share: float = 1 / 2000) -> DataFrame:
    """(item_kind, item_a, item_b, n_ab, n_a, n_b, lift, llr, significant) of all pairs that occur together in
    at least ``least`` and at least ``least_share`` of ``records`` records. ``rows``: distinct
    (item_kind, record, item), stored, for it is read twice. item_a < item_b by code point.
    Records with one item, and no rows at all, give no pair."""
    support = max(least, int(np.ceil(records * least_share - 1e-9)), 1)
    frequent = (
        rows.groupBy("item_kind", "item").agg(F.count(F.lit(1)).alias("n_item")).filter(F.col("n_item") >= support)
    )
    # at most 1 / least_share times the mean items a record; ordered by code point, one task of that size
    numbered = materialize(
        frequent.groupBy("item_kind")
        .agg(F.array_sort(F.collect_list(F.struct("item", "n_item"))).alias("all"))
        .select("item_kind", F.posexplode("all").alias("number", "x"))
        .select("item_kind", "number", "x.item", "x.n_item"),
        "items",
    )
    numbers = numbered.select("item_kind", "item", "number")
    if numbered.count() <= BROADCAST_ITEMS:
        coded = rows.join(F.broadcast(numbers), ["item_kind", "item"])
    else:
        coded = replicated(rows, numbers, ["item_kind", "item"], ["record"], salts=16)
    baskets = (
        coded
        .groupBy("item_kind", "record").agg(F.collect_list("number").alias("items"))
        .filter(F.size("items") > 1).select("item_kind", "items")
    )
    merged = (
        # the arrays are sent; the aggregate finds each item and block in one place and sends nothing
        baskets.mapInArrow(_stripe, STRIPES).repartition("item_kind", "a", "block")
        .select("item_kind", "a", "block", F.explode(F.arrays_zip("neighbours", "counts")).alias("x"))
        .groupBy("item_kind", "a", "block", F.col("x.neighbours").alias("b")).agg(F.sum("x.counts").alias("n_ab"))
        .filter(F.col("n_ab") >= support)
    )
    named = merged
    for side in ("a", "b"):
        names = numbered.select("item_kind", F.col("number").alias(side), F.col("item").alias(f"item_{side}"), F.col("n_item").alias(f"n_{side}"))
        named = named.join(names, ["item_kind", side])
    n = F.lit(records).cast("long")
    return named.select(
        "item_kind", "item_a", "item_b", "n_ab", "n_a", "n_b",
        (F.col("n_ab").cast("double") * n / (F.col("n_a") * F.col("n_b"))).alias("lift"),
        log_likelihood(F.col("n_ab"), F.col("n_a"), F.col("n_b"), n).alias("llr"),
    ).withColumn("significant", (F.col("llr") >= SIGNIFICANT) & (F.col("lift") > 1))
