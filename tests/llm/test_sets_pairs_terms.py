import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.llm import frequency, items, nearsets, together
from graphloom.sources.shared import materialize, scratch_path


def near_sets(spark, sets):
    rows = [(k, i, m) for k, (s, m) in sets.items() for i in s]
    df = spark.createDataFrame(rows, "key string, item string, measure bigint")
    each, members = nearsets.classes(df.select("key", "item"), df.select("key", "measure").distinct(), "key", "measure")
    each = materialize(each, "each")
    pairs = materialize(nearsets.class_pairs(each), "pairs")
    return each, members, pairs


def brute_near(sets):
    out = set()
    for (a, (s, m)), (b, (t, n)) in itertools.combinations(sorted(sets.items()), 2):
        if min(len(s), len(t)) >= 6 and None not in (m, n) and abs(m - n) * 10 <= max(m, n) and len(s & t) * 10 >= 7 * len(s | t):
            out.add((a, b))
    return out


def random_sets(seed, n=120):
    rng = random.Random(seed)
    sets = {}
    for i in range(n):
        if sets and rng.random() < 0.7:
            base, m = rng.choice(list(sets.values()))
            base = set(base)
            for _ in range(rng.randrange(3)):
                base.symmetric_difference_update({f"i{rng.randrange(60)}"})
            sets[f"k{i:03d}"] = (frozenset(base), rng.choice([m, (m or 0) + rng.randrange(4), None]))
        else:
            sets[f"k{i:03d}"] = (frozenset(f"i{rng.randrange(60)}" for _ in range(rng.randrange(1, 14))), rng.randrange(10, 40))
    return {k: v for k, v in sets.items() if v[0]}


def test_near_sets_equal_brute_force(spark, monkeypatch):
    for seed, block in ((1, 4096), (2, 3)):  # a block of 3 cuts every tile
        monkeypatch.setattr(nearsets, "BLOCK", block)
        monkeypatch.setattr(nearsets, "MEMBERS", block)
        sets = random_sets(seed)
        each, members, pairs = near_sets(spark, sets)
        got = [tuple(r) for r in nearsets.key_pairs(pairs, members, "key").collect()]
        assert len(got) == len(set(got)) and set(got) == brute_near(sets)


def test_groups_are_components(spark):
    sets = random_sets(4)
    each, members, pairs = near_sets(spark, sets)
    group = {r["key"]: r["group_id"] for r in members.join(nearsets.components(each, pairs), "class_id").collect()}
    parent = {k: k for k in group}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_near(sets):
        parent[root(a)] = root(b)
    for a, b in itertools.combinations(group, 2):
        assert (group[a] == group[b]) == (root(a) == root(b))


def test_long_chain_of_links(spark):
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(60)], "class_id string")
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(59)], "class_a string, class_b string")
    assert {r["group_id"] for r in nearsets.components(nodes, edges).collect()} == {"000"}
    assert nearsets.components(nodes, edges.limit(0)).filter("class_id <> group_id").count() == 0


def test_near_sets_of_nothing(spark):
    df = spark.createDataFrame([], "key string, item string, measure bigint")
    each, members = nearsets.classes(df.select("key", "item"), df.select("key", "measure"), "key", "measure")
    assert nearsets.class_pairs(each).count() == 0 and members.count() == 0


def test_pairs_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    baskets = {f"r{i}": {f"x{rng.randrange(12)}" for _ in range(rng.randrange(1, 7))} for i in range(200)}
    rows = [("kind", r, x) for r, s in baskets.items() for x in s]
    df = materialize(spark.createDataFrame(rows, "item_kind string, record string, item string"), "rows")
    single, both = Counter(), Counter()
    for s in baskets.values():
        single.update(s)
        both.update(itertools.combinations(sorted(s), 2))
    want = {(a, b): (n, single[a], single[b]) for (a, b), n in both.items() if n >= 12}
    for gather, limit, bits in ((2_000_000, 500_000, 12), (7, 1, 1)):
        monkeypatch.setattr(together, "BLOCK_BITS", bits)
        monkeypatch.setattr(together, "GATHER", gather)
        monkeypatch.setattr(together, "BROADCAST_ITEMS", limit)
        got = {(r["item_a"], r["item_b"]): r for r in together.pairs(df, 200).collect()}
        assert {k: (r["n_ab"], r["n_a"], r["n_b"]) for k, r in got.items()} == want
    n = 200
    for (a, b), (k, x, y) in want.items():
        cells = ((k, x, y), (x - k, x, n - y), (y - k, n - x, y), (n - x - y + k, n - x, n - y))
        llr = 2 * sum(c * math.log(c * n / (r * s)) for c, r, s in cells if c)
        assert abs(got[a, b]["llr"] - llr) < 1e-6 and abs(got[a, b]["lift"] - k * n / (x * y)) < 1e-9
    assert together.pairs(df.limit(0), 0).count() == 0


def counts(rows):
    return {t: (sum(1 for x, _ in rows if x == t), len({r for x, r in rows if x == t})) for t in {x for x, _ in rows}}


def test_signed_changes_equal_counting_anew(spark, monkeypatch):
    rng = random.Random(2)
    make = lambda n: [(f"t{rng.randrange(8)}", f"r{rng.randrange(20)}") for _ in range(n)]
    first = make(80)
    gone = [x for x in first if x[1] in ("r1", "r2", "r3")]
    added = make(15) + [("t1", "r1")]
    after = [x for x in first if x not in gone] + added
    df = lambda rows: spark.createDataFrame([("f", t, r) for t, r in rows], "field string, term string, record string").withColumn("bucket", F.lit("clash"))
    store = frequency.TermStore(spark, scratch_path(spark, "terms"))
    read = lambda: {r["term"]: (r["occurrences"], r["records"]) for r in store.counts().collect()}
    store.apply(1, frequency.changes(added=df(first)))
    assert read() == counts(first)
    delta = frequency.changes(df(added), df(gone))
    # a run that wrote its records and died before its terms
    with monkeypatch.context() as broken:
        broken.setattr(store, "_sum_terms", lambda epochs: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.apply(2, delta)
    assert read() == counts(first)
    store.apply(2, delta)
    store.apply(2, delta)
    assert read() == counts(after)
    store.fold()
    assert read() == counts(after) and len(store._epochs()) == 1
    assert {(r["term"], r["record"]): r["n"] for r in store.records().collect()} == dict(Counter(after))
    marks = {r["term"]: r["mark"] for r in frequency.marked(store.counts(), {"f": (20, 0.5)}).collect()}
    assert all(marks[t] == ("common" if n > 10 else "rare" if n < 3 else "") for t, (_, n) in counts(after).items())
    store.apply(3, frequency.changes(deleted=df(after)))
    assert read() == {} and store.records().count() == 0
    store.apply(4, delta.limit(0))
    assert read() == {}


def test_older_folders_are_left_alone(spark):
    import os

    path = scratch_path(spark, "terms")
    store = frequency.TermStore(spark, path)
    df = lambda rows: spark.createDataFrame([("f", *r) for r in rows], "field string, term string, record string")
    store.apply(1, frequency.changes(added=df([(f"t{i}", f"r{i}") for i in range(100)])))
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    store.apply(2, frequency.changes(added=df([("t1", "r1"), ("t1", "r2")])))
    assert before < files()
    # only what the new records hold is stored for them
    assert spark.read.parquet(f"{path}/records-{2:012d}").count() == 2
    got = {r["term"]: (r["occurrences"], r["records"]) for r in store.counts().collect()}
    assert got["t1"] == (3, 2) and got["t2"] == (1, 1)
    store.apply(3, frequency.changes(deleted=df([("t1", "r1")] * 9)))  # more than there are
    assert {r["term"]: (r["occurrences"], r["records"]) for r in store.counts().collect()}["t1"] == (1, 1)


def test_items_of_dirty_rows(spark):
    flows = spark.createDataFrame(
        [("w", [" Pack-A ", "h.example/o/r", None, "", "pack-a"]), ("w", None), (None, ["x"])], "workflow_id string, pack_set array<string>"
    ).withColumns({"item": F.lit("clash"), "repo": F.lit("clash")})
    packs = spark.createDataFrame([("Pack-R", "H.example/o/r"), ("pack-s", "h.example/o/r"), ("p", None)], "pack_id string, repo string")
    assert {tuple(r) for r in items.pack_rows(flows, packs, "workflow_id").collect()} == {("w", "pack-a"), ("w", "pack-r")}
    nodes = spark.createDataFrame([("w", " A\t"), ("w", "A"), ("w", None), (None, "B"), ("w", " ")], "workflow_id string, class_type string")
    assert {tuple(r) for r in items.class_rows(nodes).collect()} == {("w", "A")}
    raw = spark.createDataFrame([("c", [" X  y", "x Y", None, " "]), ("d", None), (None, ["z"])], "capture_id string, tags array<string>").withColumn("term", F.lit("clash"))
    assert [tuple(r) for r in items.tag_terms(raw).collect()] == [("tags", "x y", "c")] * 2
