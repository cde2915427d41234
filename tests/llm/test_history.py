import hashlib
import random

from pyspark.sql import functions as F

from graphloom.llm import history, queries
from graphloom.sources.shared import materialize, scratch_path

RECORDS = "batch_no int, record string, kind string, value string"


def random_records(seed, n=200):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(40)] + ["", None, "x", "long" * 3000]
    return list({(rng.randrange(1, 7), f"r{k}", rng.choice("ab"), rng.choice(pool)) for k in range(n)})


def digest(text):
    return hashlib.sha256(text.encode()).digest()[:16]


def brute(rows):
    return {(b, k, digest(v)) for b, _, k, v in rows if v and any(x == k and y == v and z < b for z, _, x, y in rows)}


def chunks_of(spark, rows):
    return materialize(history.chunked(history.distinct_values(spark.createDataFrame(rows, RECORDS))), "chunks")


def test_chunks_tile_the_value_and_depend_on_content_only():
    rng = random.Random(1)
    for size in (0, 1, 7, 64, 5000, 300_000):
        data = bytes(rng.randrange(256) for _ in range(size))
        ends = history.boundaries(data)
        assert ends == sorted(set(ends)) and (ends[-1:] == [size] or size == 0)
        assert all(b - a <= history.MOST for a, b in zip([0, *ends], ends, strict=False))
    data = bytes(rng.randrange(256) for _ in range(20_000))
    cut = lambda d: {d[a:b] for a, b in zip([0, *history.boundaries(d)], history.boundaries(d), strict=False)}
    assert len(cut(data) & cut(b"inserted" + data)) > 0.9 * len(cut(data))


def test_batch_by_batch_equals_brute_force_and_repeats_change_nothing(spark):
    rows = random_records(3)
    chunks = chunks_of(spark, rows)
    store, got = history.ChunkHistory(spark, scratch_path(spark, "history")), set()
    for batch in range(1, 7):
        own = chunks.filter(F.col("batch_no") == batch)
        for _ in range(2):  # a run that died after its append is run again
            held = store.take(batch, own)
            now = {(batch, r["kind"], bytes(r["value_id"])) for r in held.collect()}
        got |= now
    assert got == brute(rows)
    stored = spark.read.parquet(store.path)
    # a value is stored once, with the record that brought it
    assert stored.select("kind", "value_id", "batch_no").distinct().groupBy("kind", "value_id").count().filter("count > 1").count() == 0
    assert stored.filter("record IS NULL").count() == 0


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "inserted", f"{rng.randrange(10**6)}"]) + text[at + rng.randrange(8) :]
    return text


def test_planted_edits_are_found_again(spark):
    rng = random.Random(5)
    words = [f"{rng.randrange(36**4):x}" for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(60)]
    rows = [(1, f"old{k}", "graph", t) for k, t in enumerate(texts)]
    rows += [(2, f"new{k}", "graph", edited(rng, t, 3)) for k, t in enumerate(texts)]
    rows += [(2, f"other{k}", "graph", " ".join(rng.choices(words, k=400))) for k in range(60)]
    chunks = chunks_of(spark, rows)
    store = history.ChunkHistory(spark, scratch_path(spark, "history"))
    store.take(1, chunks.filter("batch_no = 1"), 0.8, exact=False)
    names = {digest(v): r for b, r, _, v in rows if b == 2}
    held = {(names[bytes(r["value_id"])], r["held_record"]) for r in store.matches(2, chunks.filter("batch_no = 2"), 0.8).collect()}
    planted = {(f"new{k}", f"old{k}") for k in range(60)}
    assert held <= planted and len(held) >= 0.9 * len(planted)


def test_only_touched_buckets_are_read(spark):
    rng = random.Random(7)
    text = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(64))
    rows = [(1, f"r{k}", "a", text()) for k in range(200)]
    store = history.ChunkHistory(spark, scratch_path(spark, "history"), buckets=64)
    chunks = chunks_of(spark, [*rows, (2, "n", "a", rows[0][3])])
    store.take(1, chunks.filter("batch_no = 1"))
    new = chunks.filter("batch_no = 2")
    touched = {r["b"] for r in new.select(store._bucket().alias("b")).collect()}
    stored, _ = store._touched(2, new)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(touched) < 10
    read = {r["b"] for r in stored.select(F.pmod(F.xxhash64("chunk"), F.lit(64)).alias("b")).collect()}
    assert read <= touched and {r["held_record"] for r in store.matches(2, new).collect()} == {"r0"}


def test_boilerplate_does_not_make_candidates(spark):
    rng = random.Random(9)
    boiler = "".join(rng.choice("abcdefgh") for _ in range(1000))
    own = lambda: "".join(rng.choice("abcdefgh") for _ in range(1000))
    rows = [(1, f"o{k}", "graph", boiler + own()) for k in range(50)] + [(2, f"n{k}", "graph", boiler + own()) for k in range(50)]
    chunks = chunks_of(spark, rows)
    store = history.ChunkHistory(spark, scratch_path(spark, "history"))
    store.append(1, chunks.filter("batch_no = 1"))
    assert store.matches(2, chunks.filter("batch_no = 2"), 0.8).count() == 0
    assert store.matches(2, chunks.filter("batch_no = 2"), 0.4).count() == 2500


def test_long_values_nulls_and_nothing(spark):
    long = "".join(map(str, range(400_000)))
    chunks = chunks_of(spark, [(1, "r", "t", long), (1, None, "t", "x"), (None, "r", "t", "y"), (1, "r", None, "z"), (1, "r", "t", None), (2, "q", "t", long)])
    assert "value" not in chunks.columns and chunks.filter("batch_no = 2").count() > 1000 and chunks.filter("record IS NULL").count() == 1
    store = history.ChunkHistory(spark, scratch_path(spark, "history"))
    assert store.take(1, chunks.filter("batch_no = 1")).count() == 0
    assert [r["held_record"] for r in store.take(2, chunks.filter("batch_no = 2")).collect()] == ["r"]
    assert store.take(3, chunks.limit(0)).count() == 0


def test_p1_near_on_small_tables(spark, tmp_path):
    graph = lambda n, extra="": '{"g":{"nodes":[' + ",".join(f'{{"id":{k},"type":"Class{(k * 7 + n) % 50}","w":[{k * n}]}}' for k in range(60)) + f'{extra}]}}}}'
    flows = [("w1", 1), ("w2", 2), ("w3", 2), (None, 2), ("w1", 2)]
    spark.createDataFrame(flows, "workflow_id string, batch_no int").write.parquet(f"{tmp_path}/derived_workflows.parquet")
    metas = [("w1", graph(3)), ("w2", graph(3, ',{"id":99,"type":"Z"}')), ("w3", graph(11)), ("w3", "{"), ("", graph(3)), ("w2", None)]
    spark.createDataFrame(metas, "workflow_id string, source_meta string").write.parquet(f"{tmp_path}/raw_artifacts.parquet")
    got = {(r["workflow_id"], r["held_workflow_id"], r["held_batch"]): r["coverage"] for r in queries.p1_near(spark, str(tmp_path)).collect()}
    assert set(got) == {("w1", "w1", 1), ("w2", "w1", 1)} and got["w1", "w1", 1] == 1.0 and 0.8 <= got["w2", "w1", 1] < 1
