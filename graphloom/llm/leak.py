"""P8. Test passages inside training texts, by spaced seeds.

A seed is a fixed mask over neighbouring words; its hash leaves out the masked positions, so
a window still meets its copy when words there were replaced. The seeds of the test items are a
table. A Bloom filter of them, of bounded size however many they are, goes to every task; each
document is read once and gives only the windows that pass it, with the words around them, and
nothing of all other text is sent anywhere. Windows and test seeds are then joined by hash, and
around each hit the aligned words are compared: that gives the longest stretch without a change
and the longest one with a bounded share of replaced words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.words import words
from graphloom.operators.skew import small_join
from graphloom.sources.shared import materialize

#: 1: the word counts, 0: it may be any word. All span 13 words, so 13 equal words always hit.
MASKS = ("1110110010111", "1101001110011")
#: One of these meets every stretch of 13 words or more with at most a fifth replaced. They were chosen
#: to meet all ways to replace 2 of 13 or 14 and 3 of 15 words, and all those of 16 to 29 words in which
#: no 15 neighbours have 3 or fewer replaced. Longer ones hold such 15 words, or a clean run of 8.
FULL_MASKS = ("1101111", "11010001011", "1110001000101")
#: Shorter stretches are no finding, but for items that are shorter themselves and stand there whole.
LEAST_WORDS = 13
#: Items under this are not looked for: nearly every text has them.
LEAST_SHORT = 5
#: Replaced words that an overlap may have for each of its words.
SUBSTITUTION_SHARE = 0.2
#: Bits of the filter for each seed, and at most.
SEED_BITS, MOST_BITS = 64, 1 << 28
ITEMS = "item_id bigint, item_key bigint, item_words array<bigint>"
PIECES = "doc_id bigint, piece bigint, words array<bigint>, seeds array<bigint>, places array<int>"
RESULT = "doc_id bigint, item_id bigint, item_words int, exact_words int, overlap_words int, substitutions int"
_CACHE = 500_000


def word_hashes(tokens: list[str], cache: dict[str, int]) -> list[int]:
    out = []
    for token in tokens:
        value = cache.get(token)
        if value is None:
            if len(cache) > _CACHE:
                cache.clear()
            value = cache[token] = xxhash.xxh64_intdigest(token)
        out.append(value)
    return out


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed hash of each window of ``hashes``; empty if there are fewer words than the mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, xxhash.xxh64_intdigest(mask), dtype=np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            factor = np.uint64(xxhash.xxh64_intdigest(f"{mask}:{at}") | 1)
            total += hashes[at : at + n] * factor
    return total


def overlap(same: np.ndarray, share: float = SUBSTITUTION_SHARE) -> tuple[int, int, int]:
    """Of a vector of agreeing places: the longest run of agreement; the length and the
    disagreements of the longest stretch that begins and ends in agreement and has at most
    ``share`` disagreements for each place."""
    edges = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return 0, 0, 0
    exact = int((ends - starts).max())
    # a stretch from start i to end j fits if the weight at j is not under that at i
    weight = np.r_[0.0, np.cumsum(np.where(same, share, share - 1.0))]
    best = (0, 0)
    for start in starts:
        fits = ends[(ends > start) & (weight[ends] >= weight[start] - 1e-9)]
        if len(fits) and fits[-1] - start > best[0]:
            best = (int(fits[-1] - start), int((~same[start : fits[-1]]).sum()))
    return exact, *best


def _short_masks(lengths: list[int]) -> tuple[str, ...]:
    return tuple("1" * n for n in lengths)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[str, int] = {}
    for batch in batches:
        ids, keys, lists = [], [], []
        for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            hashes = np.array(word_hashes(words(text), cache), dtype=np.uint64)
            if len(hashes) >= LEAST_SHORT:
                ids.append(item)
                keys.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
                lists.append(hashes.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["item_id", "item_key", "item_words"]
        )


def item_table(items: DataFrame) -> DataFrame:
    """(item_id, item_key, item_words): the hashes of the words of each item; items with a null id or
    text, or under LEAST_SHORT words, are left out, equal ones come once."""
    wanted = items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    return wanted.mapInArrow(_item_words, ITEMS).dropDuplicates(["item_id", "item_key"])


def item_seeds(table: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(item_key, seed, place) of all windows of all items under the masks; an item shorter than
    LEAST_WORDS has one seed, all its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), _lists(batch.column(1)), strict=True):
                hashes = own.view(np.uint64)
                for mask in masks if len(hashes) >= LEAST_WORDS else _short_masks([len(hashes)]):
                    seeds = seed_hashes(hashes, mask).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(seeds), key)), pa.array(seeds), pa.array(np.arange(len(seeds), dtype=np.int32))], names=["item_key", "seed", "place"]
                    )

    return table.select("item_key", "item_words").dropDuplicates(["item_key"]).mapInArrow(run, "item_key bigint, seed bigint, place int")


def _bits(seeds: np.ndarray, size: int) -> np.ndarray:
    """The four bits of each seed in a filter of ``size`` bits, a power of two."""
    step = (seeds >> np.uint64(32)) | np.uint64(1)
    return np.stack([(seeds + np.uint64(n) * step) & np.uint64(size - 1) for n in range(4)])


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of all seeds as 64-bit words, MOST_BITS at most; built in the tasks."""
    count = seeds.count()
    size = 1 << min(max(16, (max(count, 1) * SEED_BITS - 1).bit_length()), MOST_BITS.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(_bits(batch.column(0).to_numpy().view(np.uint64), size))
            slots, masks = (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63))
            starts = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.empty(0, np.int64)
            folded = np.bitwise_or.reduceat(masks, starts) if len(slots) else masks
            yield pa.RecordBatch.from_arrays([pa.array(slots[starts]), pa.array(folded.view(np.int64))], names=["slot", "bits"])

    filled = seeds.select("seed").mapInArrow(run, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, dtype=np.uint64)
    out[filled.column("slot").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    return out


def _passing(seeds: np.ndarray, words_of: np.ndarray) -> np.ndarray:
    """Which seeds a filter lets pass."""
    bits = _bits(seeds, len(words_of) * 64)
    hit = np.ones(len(seeds), dtype=bool)
    for row in bits:
        hit &= (words_of[(row >> np.uint64(6)).astype(np.int64)] >> (row & np.uint64(63))) & np.uint64(1) == 1
    return hit


def pieces(documents: DataFrame, filter_words: np.ndarray, masks: tuple[str, ...], reach: int) -> DataFrame:
    """(doc_id, piece, words, seeds, places): of each document the stretches within ``reach`` words of
    a window that passes the filter, as word hashes, and those windows. Documents without one give
    nothing, nor do those with a null id or text."""
    shared = documents.sparkSession.sparkContext.broadcast(filter_words)
    shortest = min(map(len, masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for batch in batches:
            ids, lists = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = words(text)
                if len(tokens) >= shortest:
                    ids.append(doc)
                    lists.append(word_hashes(tokens, cache))
            if ids:
                yield _cut(np.array(ids), lists, shared.value, masks, reach)

    docs = documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, PIECES)


def _cut(ids: np.ndarray, lists: list[list[int]], filter_words: np.ndarray, masks: tuple[str, ...], reach: int) -> pa.RecordBatch:
    lengths = np.array([len(x) for x in lists])
    starts = np.r_[0, np.cumsum(lengths)]
    every = np.fromiter((h for x in lists for h in x), dtype=np.uint64, count=int(starts[-1]))
    owner = np.repeat(np.arange(len(ids)), lengths)
    found_at, found_seed = [], []
    for mask in masks:
        seeds = seed_hashes(every, mask)
        at = np.flatnonzero(owner[: len(seeds)] == owner[len(mask) - 1 : len(mask) - 1 + len(seeds)])
        at = at[_passing(seeds[at], filter_words)]
        found_at.append(at)
        found_seed.append(seeds[at])
    at, seed = np.concatenate(found_at), np.concatenate(found_seed)
    order = np.argsort(at, kind="stable")
    at, seed = at[order], seed[order]
    out: list[tuple] = []
    # windows of one document that lie closer than twice the reach belong to one piece
    apart = np.flatnonzero((owner[at[1:]] != owner[at[:-1]]) | (at[1:] - at[:-1] > 2 * reach)) + 1
    for group in np.split(np.arange(len(at)), apart) if len(at) else ():
        doc = owner[at[group[0]]]
        low, high = max(starts[doc], at[group[0]] - reach), min(starts[doc + 1], at[group[-1]] + reach)
        own = every[low:high]
        piece = xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)
        out.append((ids[doc], piece, own.view(np.int64), seed[group].view(np.int64), (at[group] - low).astype(np.int32)))
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
    columns = zip(*out, strict=True) if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in PIECES.split(", ")])


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column as pieces of one array."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        ids = [batch.column(n).to_pylist() for n in (0, 1)]
        for doc, item, own, other, shifts in zip(*ids, *(_lists(batch.column(n)) for n in (2, 3, 4)), strict=True):
            for shift in shifts.tolist():
                low, high = max(0, -shift), min(len(other), len(own) - shift)
                same = other[low:high] == own[low + shift : high + shift]
                if len(other) < LEAST_WORDS:
                    if len(same) == len(other) and same.all():
                        out.append((doc, item, len(other), len(other), len(other), 0))
                elif np.count_nonzero(same) >= (1 - SUBSTITUTION_SHARE) * LEAST_WORDS:
                    exact, length, changed = overlap(same)
                    if length >= LEAST_WORDS:
                        out.append((doc, item, len(other), exact, length, changed))
        types = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def overlaps(documents: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """(doc_id, item_id, item_words, exact_words, overlap_words, substitutions) of each document and item
    that a seed brings together: longest equal stretch, longest stretch with substitutions (of at
    least LEAST_WORDS), and how many those are. FULL_MASKS miss no such stretch; MASKS are cheaper
    and miss no equal one. An item of LEAST_SHORT words or more, but under LEAST_WORDS, must stand
    whole in the document. Null, empty and short texts meet nothing. Rows with a null id are left
    out; of a doc_id or item_id that comes again the longest of all its texts counts."""
    spark = documents.sparkSession
    table = materialize(item_table(items), "items")
    sizes = table.agg(
        F.max(F.size("item_words")).alias("most"),
        F.collect_set(F.when(F.size("item_words") < LEAST_WORDS, F.size("item_words"))).alias("short"),  # a few lengths
    ).head()
    if sizes["most"] is None:
        return spark.createDataFrame([], RESULT)
    seeds = materialize(item_seeds(table, masks), "seeds")
    every = (*masks, *_short_masks(sorted(sizes["short"])))
    found = materialize(pieces(documents, seed_filter(seeds), every, sizes["most"] + LEAST_WORDS), "pieces")
    windows = found.select("doc_id", "piece", F.explode(F.arrays_zip("seeds", "places")).alias("w")).select(
        "doc_id", "piece", F.col("w.seeds").alias("seed"), F.col("w.places").alias("at")
    )
    hits = (
        small_join(windows, seeds, ["seed"], ["doc_id", "piece"], "inner")
        .groupBy("doc_id", "piece", "item_key").agg(F.collect_set(F.col("at") - F.col("place")).alias("shifts"))
    )
    aligned = small_join(hits, table, ["item_key"], ["doc_id", "piece"], "inner").join(found.select("doc_id", "piece", "words"), ["doc_id", "piece"])
    checked = aligned.select("doc_id", "item_id", "words", F.col("item_words"), "shifts").mapInArrow(_verify, RESULT)
    longest = F.max(F.struct("overlap_words", (-F.col("substitutions")).alias("kept"))).alias("longest")
    return checked.groupBy("doc_id", "item_id").agg(F.max("item_words").alias("item_words"), F.max("exact_words").alias("exact_words"), longest).select(
        "doc_id", "item_id", "item_words", "exact_words", "longest.overlap_words", (-F.col("longest.kept")).alias("substitutions")
    )
