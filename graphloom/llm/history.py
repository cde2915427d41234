"""P1. Checking each new batch against everything held, by content-defined chunks.

A value is cut where a rolling hash of its last bytes meets a mask, so equal stretches give
equal chunks wherever they stand. A stored table maps each chunk to the values that hold it and
the record that brought them. The chunks of a new batch are looked up there; the bytes that a new
value shares with one held value, over all its bytes, are its coverage by it, and the decision is
a threshold on that. The chunks of accepted values are appended.

The table lies in folders by batch and by hash bucket of the chunk. A batch reads the buckets that
it touches and sends on only rows whose chunk it has itself, so what is shuffled follows the
batch and its hits, not the history. A value goes by its digest once it is cut: chunk rows do not
carry it, however long it is. Equal values are one value with the number of its records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.operators.skew import small_join
from graphloom.sources.shared import exists, materialize, measured

#: Least bytes of a chunk, zero bits that end one, most bytes: for digests, and for texts by kind.
LEAST, MASK_BITS, MOST = 8, 4, 256
SIZES = {"graph": (24, 5, 512)}
KEY = ["kind", "value_id"]
CHUNKS = "kind string, value_id binary, record string, batch_no int, chunk binary, chunk_bytes int, value_bytes int"
STORED = "chunk binary, kind string, value_id binary, record string, chunk_bytes int, value_bytes int, batch_no int, bucket int"
MATCHES = "kind string, value_id binary, held_id binary, held_record string, held_batch int, shared_bytes bigint, value_bytes int"
#: Chunks of a batch, or held values, up to which they go to every task that reads the table.
BROADCAST_CHUNKS = 500_000

#: Random 32-bit words by byte value, from a fixed seed.
GEAR = np.frombuffer(b"".join(hashlib.sha256(b"gear %d" % i).digest()[:4] for i in range(256)), dtype="<u4")


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: the sum over the last 32 bytes of GEAR shifted by distance,
    modulo 2**32, in five doubling steps."""
    hashed = GEAR[data].copy()
    for step in (1, 2, 4, 8, 16):
        later = hashed.copy()
        later[step:] += hashed[:-step] << np.uint32(step)
        hashed = later
    return hashed


def boundaries(value: bytes, least: int = LEAST, mask_bits: int = MASK_BITS, most: int = MOST) -> list[int]:
    """Ends of the chunks of a value: places where the rolling hash of the value has ``mask_bits``
    zero bits, at least ``least`` and at most ``most`` bytes apart, and its end. [] for b''."""
    if not value:
        return []
    hashed = rolling(np.frombuffer(value, dtype=np.uint8))
    cuts = (np.flatnonzero((hashed >> np.uint32(32 - mask_bits)) == 0) + 1).tolist()
    ends, last = [], 0
    for cut in [*cuts, len(value)]:
        while cut - last > most:
            last += most
            ends.append(last)
        if cut - last >= least or cut == len(value) and cut > last:
            ends.append(cut)
            last = cut
    return ends


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, chunks, sizes, totals = [], [], [], []
        for row, (kind, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True)):
            data = value.encode("utf-8", "surrogatepass")
            own: dict[bytes, int] = {}
            start = 0
            for end in boundaries(data, *SIZES.get(kind, (LEAST, MASK_BITS, MOST))):
                digest = hashlib.blake2b(data[start:end], digest_size=12, key=kind.encode()[:64]).digest()
                own[digest] = own.get(digest, 0) + end - start
                start = end
            at += [row] * len(own)
            chunks += own.keys()
            sizes += own.values()
            totals += [len(data)] * len(own)
        rest = batch.select([0, 1, 2, 3]).take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(chunks, pa.binary()), pa.array(sizes, pa.int32()), pa.array(totals, pa.int32())],
            names=[*KEY, "record", "batch_no", "chunk", "chunk_bytes", "value_bytes"],
        )


def value_id(column: str = "value") -> Column:
    return F.unhex(F.substring(F.sha2(F.col(column), 256), 1, 32))


def distinct_values(records: DataFrame) -> DataFrame:
    """(batch_no, kind, value_id, value, record, n): the distinct values of (batch_no, record, kind,
    value), with how many records of the batch have each and the least of those. Null and empty
    values, and null batches and kinds, are left out. A value that a third of all records share
    is one row after the partial aggregate."""
    return (
        records.filter((F.col("value") != "") & F.col("batch_no").isNotNull() & F.col("kind").isNotNull())
        .groupBy(F.col("batch_no").cast("int").alias("batch_no"), "kind", value_id().alias("value_id"))
        .agg(F.any_value("value").alias("value"), F.min("record").alias("record"), F.count(F.lit(1)).alias("n"))
    )


def chunked(values: DataFrame) -> DataFrame:
    """Chunks of :func:`distinct_values`, one row for each chunk of a value with all the bytes it has
    there. Chunks of different kinds never meet."""
    return values.select("kind", "value_id", "record", "batch_no", "value").mapInArrow(_chunk, CHUNKS)


def _only(stored: DataFrame, keys: DataFrame, key: str, size: int) -> DataFrame:
    """Stored rows with one of the distinct keys; up to BROADCAST_CHUNKS of these go to every task, so that
    nothing of the table is sent but what is wanted. ``size`` is not under their number."""
    return stored.join(F.broadcast(keys) if size <= BROADCAST_CHUNKS else keys, key, "left_semi")


class ChunkHistory:
    """The stored chunk table at a path. ``buckets`` must stay the same over its life; choose it so
    that a bucket of all history is some hundred megabytes."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("chunk"), F.lit(self.buckets)).cast("int")

    def _touched(self, batch_no: int, chunks: DataFrame) -> tuple[DataFrame | None, int]:
        """Stored rows of earlier batches in the buckets that the batch has chunks in, None if nothing is
        stored, and how many different chunks the batch has."""
        if not exists(self.spark, self.path):
            return None, 0
        mine = chunks.select("chunk", self._bucket().alias("bucket")).distinct().groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        counts = {r["bucket"]: r["n"] for r in mine.collect()}  # at most `buckets` rows
        stored = self.spark.read.schema(STORED).parquet(self.path)
        return stored.filter(F.col("bucket").isin(list(counts)) & (F.col("batch_no") < batch_no)).select(
            "chunk", F.col("value_id").alias("held_id"), F.col("record").alias("held_record"), F.col("batch_no").alias("held_batch"),
            F.col("chunk_bytes").alias("held_bytes"), F.col("value_bytes").alias("held_total"),
        ), sum(counts.values())

    def matches(self, batch_no: int, chunks: DataFrame, threshold: float = 1.0) -> DataFrame:
        """Rows of MATCHES: each value of the batch and held value of an earlier batch that covers it
        by at least ``threshold``. ``chunks`` (of this batch) should be stored.

        A value that covers so much must hold one of any chunks that together have more than the
        bytes that may be missing. So it is first counted how many values hold each chunk; the rarest
        chunks of each value then look for candidates, and boilerplate never does; and only for those
        candidates all chunks are compared. The table is read three times and filtered as it is read."""
        stored, n_chunks = self._touched(batch_no, chunks)
        if stored is None:
            return self.spark.createDataFrame([], MATCHES)
        own = chunks.select(*KEY, "chunk", "chunk_bytes", "value_bytes")
        holders = _only(stored, own.select("chunk").distinct(), "chunk", n_chunks).groupBy("chunk").agg(F.count(F.lit(1)).alias("holders"))
        holders, n_held = measured(holders, "holders")
        known = small_join(own, holders, ["chunk"], ["value_id"], limit=BROADCAST_CHUNKS, size=n_held).withColumn("holders", F.coalesce("holders", F.lit(0)))
        rarest = Window.partitionBy(*KEY).orderBy("holders", "chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("chunk_bytes").over(rarest) - F.col("chunk_bytes")
        probes = known.withColumn("before", before).filter((F.col("before") <= F.lit(1 - threshold + 1e-9) * F.col("value_bytes")) & (F.col("holders") > 0))
        probes, n_probes = measured(probes.select(*KEY, "chunk", "value_bytes"), "probes")
        candidates = (
            small_join(stored, probes, ["chunk"], ["held_id"], "inner", BROADCAST_CHUNKS, n_probes)
            .filter(F.col("held_total") >= F.lit(threshold - 1e-9) * F.col("value_bytes"))
            .select(*KEY, "held_id").distinct()
        )
        candidates, n_candidates = measured(candidates, "candidates")
        held = _only(stored, candidates.select("held_id").distinct(), "held_id", n_candidates)
        shared = F.sum(F.least("chunk_bytes", "held_bytes")).alias("shared_bytes")
        return (
            candidates.join(own, KEY)
            .join(held, ["held_id", "chunk"])
            .groupBy(*KEY, "held_id")
            .agg(shared, F.any_value("value_bytes").alias("value_bytes"), F.min("held_record").alias("held_record"), F.min("held_batch").alias("held_batch"))
            .filter(F.col("shared_bytes") >= F.lit(threshold - 1e-9) * F.col("value_bytes"))
            .select(*[c.split()[0] for c in MATCHES.split(", ")])
        )

    def append(self, batch_no: int, chunks: DataFrame) -> None:
        """Store the chunks of a batch. Its folders are replaced as a whole, so a run that died
        halfway is simply run again; an empty batch stores nothing."""
        rows = chunks.select("chunk", *KEY, "record", "chunk_bytes", "value_bytes", F.lit(batch_no).alias("batch_no"), self._bucket().alias("bucket"))
        (
            rows.repartition("bucket").sortWithinPartitions("bucket", "chunk").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_no", "bucket").parquet(self.path)
        )

    def take(self, batch_no: int, chunks: DataFrame, threshold: float = 1.0, exact: bool = True) -> DataFrame:
        """Check a batch and append what is accepted: the matches of its values, those of equal values
        only if ``exact``. Values with a match are not appended: what they repeat is held."""
        found = self.matches(batch_no, chunks, threshold)
        found = materialize(found.filter(F.col("value_id") == F.col("held_id")) if exact else found, "matches")
        self.append(batch_no, chunks.join(found.select(*KEY).distinct(), KEY, "left_anti"))
        return found
