import datetime as dt

from pyspark.sql import functions as F

from graphloom.operators import queue, state
from graphloom.operators.skew import lookup, replicated, small_join
from graphloom.schemas import QUEUE
from graphloom.sources.shared import materialize



def now():
    return F.timestamp_seconds(F.lit(1_700_000_000))


THEN = dt.datetime.fromtimestamp(1_700_000_000, dt.UTC).replace(tzinfo=None)


def test_latest_with_ties_nulls_and_maps(spark):
    rows = [("a", 1, "x", {"k": 1}), ("a", 2, "y", {"k": 2}), ("a", 2, "z", {"k": 3}), (None, None, "n", None), (None, 1, "m", None)]
    df = spark.createDataFrame(rows, "id string, v int, x string, m map<string,int>")
    assert {(r["id"], r["x"]) for r in state.latest(df, ["id"], ["v"]).collect()} == {("a", "z"), (None, "m")}
    assert state.latest(df.limit(0), ["id"], ["v"]).columns == df.columns
    assert state.latest(df, ["id"], ["v"]).columns == df.columns


def test_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "id string, v int")
    held = spark.createDataFrame([("a", 9), (None, 9)], "id string, other int")
    assert [tuple(r) for r in state.absent(new, held, ["id"]).collect()] == [("b", 2)]
    assert state.absent(new, held.limit(0), ["id"]).count() == 3
    assert state.absent(new.limit(0), held, ["id"]).count() == 0


def test_upsert_update_forget(spark):
    held = spark.createDataFrame([("a", "c1", "f1"), ("b", "c2", "f2")], "id string, cursor string, frontier string")
    new = spark.createDataFrame([("a", None, None), ("c", "c3", None)], "id string, cursor string, frontier string")
    got = {r["id"]: (r["cursor"], r["frontier"]) for r in state.upsert(held, new, ["id"], ["frontier"]).collect()}
    assert got == {"a": (None, "f1"), "b": ("c2", "f2"), "c": ("c3", None)}
    changed = state.update(held, spark.createDataFrame([("b", None), ("x", "n")], "id string, cursor string"), ["id"])
    assert {r["id"]: r["cursor"] for r in changed.collect()} == {"a": "c1", "b": None}
    assert [r["id"] for r in state.forget(held, new, ["id"]).collect()] == ["b"]


def test_drift_of_a_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert state.drifted(df, "a int, b string") == []
    assert state.drifted(df, "a bigint, c string") == ["a is int, not bigint", "missing c string", "unexpected b string"]


def item(n, state_, priority=1, lease=None, post=None, published=None):
    return ("s", f"a{n}", post, None, published, priority, state_, lease, 0, None)


def test_claim_finish_release(spark):
    past, future = THEN - dt.timedelta(1), THEN + dt.timedelta(1)
    rows = [
        item(1, "pending", 1, published=past), item(2, "leased", 5, past), item(3, "leased", 9, future), item(4, "done", 9), item(5, "pending", 1),
    ]
    q = spark.createDataFrame(rows, QUEUE)
    claimed, after = queue.claim(q, "s", 2, now())
    assert [r["artifact_id"] for r in claimed.collect()] == ["a2", "a1"]
    assert {r["artifact_id"]: (r["state"], r["attempts"]) for r in after.collect()}["a2"] == ("leased", 1)
    done = queue.finish(after, spark.createDataFrame([("s", "a2", "failed", "e" * 900)], "source string, artifact_id string, state string, error string"))
    row = done.filter("artifact_id = 'a2'").head()
    assert row["state"] == "failed" and len(row["last_error"]) == 500 and row["lease_until"] is None
    freed = queue.release(done, done.select("source", "artifact_id"))
    assert {r["artifact_id"] for r in freed.filter("state = 'pending'").collect()} == {"a1", "a3", "a5"}
    assert freed.filter("artifact_id = 'a4'").head()["state"] == "done"
    assert queue.queue_stats(freed).count() == 3


def test_one_per_post(spark):
    held = spark.createDataFrame([item(9, "done", post="p1"), item(8, "failed", post="p2")], QUEUE)
    items = spark.createDataFrame(
        [("s", "p1", "x1", 0), ("s", "p2", "x3", 2), ("s", "p2", "x2", 1), ("s", None, "x4", 3), ("s", None, "x5", 4)],
        "source string, post_id string, artifact_id string, position int",
    )
    assert {r["artifact_id"] for r in queue.one_per_post(items, held, "position").collect()} == {"x2", "x4", "x5"}


def test_partitions_and_expiry(spark):
    rows = [("s", "user", "k1", None, False, THEN, THEN, None), ("s", "user", "k2", None, False, None, THEN, None), ("s", "user", "k3", None, True, None, THEN, None)]
    parts = spark.createDataFrame(rows, "source string, kind string, key string, cursor string, exhausted boolean, swept_at timestamp, discovered_at timestamp, lease_until timestamp")
    claimed, after = queue.claim_partition(parts, "s", "user", now())
    assert [r["key"] for r in claimed.collect()] == ["k2"]
    assert after.filter("lease_until IS NOT NULL").count() == 1
    assert queue.partition_stats(parts).head()["exhausted"] == 1
    blobs = spark.createDataFrame([("a", THEN - dt.timedelta(2)), ("b", None), ("c", THEN + dt.timedelta(2)), ("d", THEN - dt.timedelta(1))], "sha256 string, expires_at timestamp")
    assert [r["sha256"] for r in queue.expired(blobs, now(), 1).collect()] == ["a"]
    assert queue.expired(blobs, now()).count() == 2


def test_salted_joins_agree_with_plain_ones(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k bigint, row bigint"))
    right = materialize(left.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("best")).filter("k % 2 = 0"), "right")
    for how in ("inner", "left", "left_semi"):
        plain = left.join(right.drop("n"), "k", how)
        for got in (lookup(left, right, ["k"], "n", ["row"], how), replicated(left, right.drop("n"), ["k"], ["row"], how)):
            assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    wide = small_join(left, right.drop("n"), ["k"], ["row"], "inner", limit=1)
    assert wide.count() == left.join(right, "k").count()
    assert lookup(left, right.limit(0), ["k"], "n", ["row"]).count() == 0
