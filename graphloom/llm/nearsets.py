"""P5. Near-duplicate sets, by size-banded tiles with hashed bitmaps.

Equal sets with equal size measures form one class, and only classes are compared. A class
stands in a tile for each item of its prefix (its rarest items, as many as a partner must
share one of) and for its own size band; it meets the tiles of every band a partner's size
can be in. Tiles hold a class by its number, size and bitmap alone. Inside a tile pairs are
dropped by sizes, then by bit counts: the bits in which two hashed bitmaps differ bound the
items not shared from below and so the shared ones from above. What is left, each pair once, is
joined with the sorted arrays of both and intersected exactly. Large tiles are cut into blocks
by a hash of the class.

The result that scales is one row a key: its class, the number of linked classes and the group.
Pairs of keys are made from class pairs on request; large classes are cut into blocks for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.skew import lookup, small_join
from graphloom.sources.shared import materialize

WORDS = 4  # of 64 bits a bitmap
BAND = 2  # sizes a band
BLOCK = 4096  # classes of a tile that one block holds, about
MEMBERS = 2048  # keys of a class that one block holds when pairs of keys are made, about


def compact(column: Column | str) -> Column:
    """A key as 16 bytes; null stays null."""
    return F.unhex(F.md5(column))


def _bitmap(items: Column) -> list[Column]:
    """The bitmap of a set as WORDS longs: each item sets one of 64 * WORDS bits."""
    def word(index: int) -> Column:
        own = F.filter(items, lambda i: F.pmod(i, F.lit(64 * WORDS)).cast("int").between(64 * index, 64 * index + 63))
        return F.aggregate(
            own, F.lit(0).cast("long"),
            lambda bits, i: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(i, F.lit(64)).cast("int"))),
        )

    return [word(index) for index in range(WORDS)]


def _numbered(rows: DataFrame) -> DataFrame:
    """(item, df, number): the items with how many keys hold each and a number, a hash that no two
    items share (one seed after the other is tried)."""
    ranked = materialize(rows.groupBy("item").agg(F.count(F.lit(1)).alias("df")), "ranked")
    for seed in range(100):
        numbered = ranked.withColumn("number", F.xxhash64(F.lit(seed), "item"))
        if numbered.groupBy("number").count().filter("count > 1").isEmpty():
            return numbered
    raise RuntimeError("no seed gives every item a number of its own")


def classes(rows: DataFrame, sizes: DataFrame, key: str, measure: str, least_items: int = 6) -> tuple[DataFrame, DataFrame]:
    """From distinct (key, item) rows and (key, measure), a row a key: the classes (class_id, items, n,
    measure) of keys with at least ``least_items`` items, and the members (key, class_id). Items are
    numbers in order of rarity. Keys without a measure are left out, as are those with fewer items."""
    keyed = (
        small_join(rows, _numbered(rows), ["item"], [key], "inner")
        .groupBy(key)
        .agg(F.array_sort(F.collect_set(F.struct("df", "number"))).alias("ordered"))
        .filter(F.size("ordered") >= least_items)
        .join(sizes.filter(F.col(measure).isNotNull()).select(key, F.col(measure).alias("measure")), key)
        .select(key, "measure", F.transform("ordered", lambda s: s["number"]).alias("items"))
        .withColumn("class_id", compact(F.to_json(F.struct("items", "measure"))))
    )
    keyed = materialize(keyed, "keyed")
    each = keyed.groupBy("class_id").agg(F.any_value("items").alias("items"), F.any_value("measure").alias("measure"))
    return each.withColumn("n", F.size("items")), keyed.select(key, "class_id")


def class_pairs(each: DataFrame, ratio: float = 0.7, tolerance: float = 0.1) -> DataFrame:
    """(class_a, class_b, common, n_a, n_b) of different classes whose sets have common / all at
    least ``ratio`` and whose measures differ by at most ``tolerance`` of the larger. The first
    of a pair has the smaller set, of equal sets in size the smaller id."""
    eps = 1e-9
    full = each.select("class_id", "items", "measure", "n", *[c.alias(f"w{i}") for i, c in enumerate(_bitmap(F.col("items")))])
    full = materialize(full, "signatures")
    signature = ["class_id", "measure", "n", *[f"w{i}" for i in range(WORDS)]]
    prefix = (F.col("n") - F.ceil(F.col("n") * ratio - eps) + 1).cast("int")
    tiled = full.select(*signature, F.explode(F.slice("items", F.lit(1), prefix)).alias("token"))
    own_band = F.floor(F.col("n") / BAND).cast("int")
    # classes of a tile; the list is as long as there are different items and bands
    load = tiled.groupBy("token", own_band.alias("band")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    load = materialize(load.filter("blocks > 1"), "load")
    right = (
        tiled.withColumn("band", own_band).join(load, ["token", "band"], "left")
        .withColumn("block", F.pmod(F.xxhash64("class_id"), F.coalesce("blocks", F.lit(1))).cast("int")).drop("blocks")
    )
    last_band = F.floor(F.floor(F.col("n") / ratio + eps) / BAND).cast("int")
    left = (
        tiled.withColumn("band", F.explode(F.sequence(own_band, last_band))).join(load, ["token", "band"], "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
    )
    a, b = left.alias("a"), right.alias("b")
    differing = sum((F.bit_count(F.col(f"a.w{i}").bitwiseXOR(F.col(f"b.w{i}"))) for i in range(WORDS)), F.lit(0))
    sizes = F.col("a.n") + F.col("b.n")
    # common / (sizes - common) >= ratio  <=>  common * (1 + ratio) >= ratio * sizes
    possible = (sizes - differing) / 2 * (1 + ratio) >= ratio * sizes - eps
    smaller = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.class_id") < F.col("b.class_id")))
    near = F.abs(F.col("a.measure") - F.col("b.measure")) <= tolerance * F.greatest("a.measure", "b.measure") + eps
    fits = F.col("a.n") >= ratio * F.col("b.n") - eps
    met = a.join(
        b,
        (F.col("a.token") == F.col("b.token")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.block") == F.col("b.block"))
        & smaller & fits & near & possible,
    )
    # most pairs are gone by now; one that met in several tiles comes once
    likely = met.select(F.col("a.class_id").alias("class_a"), F.col("b.class_id").alias("class_b")).distinct()
    for side in ("a", "b"):
        arrays = full.select(F.col("class_id").alias(f"class_{side}"), F.col("items").alias(f"items_{side}"), F.col("n").alias(f"n_{side}"))
        likely = likely.join(arrays, f"class_{side}")
    exact = likely.withColumn("common", F.size(F.array_intersect("items_a", "items_b")))
    return exact.filter(F.col("common") * (1 + ratio) >= ratio * (F.col("n_a") + F.col("n_b")) - eps).select("class_a", "class_b", "common", "n_a", "n_b")


def key_pairs(pairs: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """(key_a, key_b), key_a < key_b: all pairs of keys, those of one class and those of two
    classes that form a pair. Pairs, once each. Keys of one class meet in blocks, so that a class
    with a third of all keys is many tasks; ``members`` should be stored."""
    loads = members.groupBy("class_id").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks"))
    loads = materialize(loads.filter("blocks > 1"), "loads")
    sized = small_join(members, loads, ["class_id"], [key]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = sized.select("class_id", F.col(key).alias("_a"), F.pmod(F.xxhash64(key), F.col("blocks")).cast("int").alias("block"))
    all_blocks = sized.select("class_id", F.col(key).alias("_b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    within = own.join(all_blocks, ["class_id", "block"]).filter(F.col("_a") < F.col("_b")).select("_a", "_b")
    # a class pair is spread over the blocks of its first class, then meets all of its second
    first = own.select(F.col("class_id").alias("class_a"), "_a", "block")
    ends = small_join(pairs.select("class_a", "class_b"), loads.select(F.col("class_id").alias("class_a"), "blocks"), ["class_a"], ["class_b"])
    ends = ends.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
    across = (
        ends.join(first, ["class_a", "block"])
        .join(members.select(F.col(key).alias("_b"), F.col("class_id").alias("class_b")), "class_b")
    )
    return within.unionByName(across.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"))).select(
        F.col("_a").alias(f"{key}_a"), F.col("_b").alias(f"{key}_b")
    )


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(class_id, group_id): the least id reachable from each node over (class_a, class_b) edges.

    Each round every node takes the least label around it and then the label of its label, so
    chains shorten by half and more; labels are stored between rounds. Raises if
    ``most_rounds`` were not enough."""
    both = materialize(
        edges.select(F.col("class_a").alias("u"), F.col("class_b").alias("v")).union(edges.select("class_b", "class_a")).distinct(), "edges"
    )
    degrees = both.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
    sums = degrees.agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("n"), F.coalesce(F.max("degree"), F.lit(0)).alias("most")).head()
    hubs = sums["most"] > max(1_000_000, sums["n"] // 100)
    degrees = materialize(degrees, "degrees") if hubs else degrees
    labels = materialize(nodes.select("class_id", F.col("class_id").alias("label")), "labels")
    for _ in range(most_rounds):
        if hubs:  # edges of a node with very many are spread over tasks
            known = materialize(labels.select(F.col("class_id").alias("v"), "label").join(degrees, "v"), "known")
            near = lookup(both, known, ["v"], "degree", ["u"])
        else:
            near = both.join(labels.select(F.col("class_id").alias("v"), "label"), "v")
        around = near.groupBy("u").agg(F.min("label").alias("least"))
        hooked = labels.join(around, F.col("class_id") == F.col("u"), "left").select(
            "class_id", "label", F.least("label", F.coalesce("least", "label")).alias("new")
        )
        parents = hooked.select(F.col("class_id").alias("new"), F.col("new").alias("above"))
        after = materialize(
            hooked.join(parents, "new", "left").select("class_id", "label", F.least("new", "above").alias("new")), "labels"
        )
        moved = not after.filter("label <> new").isEmpty()
        labels = after.select("class_id", F.col("new").alias("label"))
        if not moved:
            return labels.withColumnRenamed("label", "group_id")
    raise RuntimeError(f"labels still moved after {most_rounds} rounds")
