import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from graphloom.operators import incremental
from graphloom.plans.problems import capture_content, p4_found, tag_set
from graphloom.sources.shared import materialize, scratch_path
from tests.conftest import SMALL

DAY = dt.datetime(2026, 1, 1)


def brute(rows, landed, runs):
    """rows: (key, version, content, manifest); runs: (seq, start, status)."""
    done = sorted((s, n) for n, s, status in runs if status == "done")
    out, before = set(), {}
    for start, seq in done:
        now = {}
        for key, version, content, manifest in rows:
            if key is not None and version is not None and manifest in landed and landed[manifest] <= start:
                now[key] = max(now.get(key, ("", "")), (version, content))
        out |= {(seq, k) for k, v in now.items() if k not in before or before[k][1] != v[1]}
        before = now
    return out


def case(spark, seed):
    rng = random.Random(seed)
    runs = [(n, DAY + dt.timedelta(days=3 * n, hours=rng.randrange(5)), rng.choice(["done", "done", "failed", "killed"])) for n in range(1, 9)]
    landed = {f"m{i}": DAY + dt.timedelta(days=rng.randrange(-3, 28), hours=rng.randrange(24)) for i in range(12)}
    versions = {}
    rows = []
    for _ in range(120):
        key, version = f"k{rng.randrange(12)}", f"v{rng.randrange(30):02d}"
        content = versions.setdefault((key, version), rng.choice("abc"))
        rows.append((key, version, content, f"m{rng.randrange(14)}"))
    rows += [(None, "v", "a", "m1"), ("k1", None, "a", "m1")]
    manifests = [(m, t) for m, t in landed.items()] + [(m, t + dt.timedelta(5)) for m, t in list(landed.items())[:3]] + [(None, DAY), ("m99", None)]
    return (
        rows, landed, runs,
        spark.createDataFrame(rows, "k string, v string, c string, manifest_key string"),
        spark.createDataFrame(manifests, "manifest_key string, landed_at timestamp"),
        spark.createDataFrame([(n, s, st) for n, s, st in runs], "run_seq int, started_at timestamp, status string"),
    )


def run(spark, path, df, manifests, runs):
    seen = materialize(incremental.arrivals(manifests, runs), "seen")
    staged = incremental.stage(df, seen, "k", F.col("v"), F.col("c"), F.substring("k", 1, 2))
    return incremental.catch_up(spark, path, staged, incremental.run_order(runs))


def test_catch_up_equals_brute_force(spark):
    for seed in range(2):
        rows, landed, runs, df, manifests, run_df = case(spark, seed)
        log = run(spark, scratch_path(spark, "t"), df, manifests, run_df)
        assert {tuple(r) for r in log.collect()} == brute(rows, landed, runs)


@pytest.mark.parametrize("place", ["_write_changes", "_replace", "write_text", "half"])
def test_run_by_run_with_a_failure_between(spark, monkeypatch, place):
    rows, landed, runs, df, manifests, run_df = case(spark, 7)
    path = scratch_path(spark, "t")

    def lost(*_):
        raise RuntimeError("lost")

    for upto in (5, 8):
        first = run_df.filter(F.col("run_seq") <= upto)
        with monkeypatch.context() as broken:  # dies before this step, or before the fingerprints
            if place == "write_text":
                put = incremental.write_text
                broken.setattr(incremental, "write_text", lambda s, p, t: lost() if p.endswith("json") else put(s, p, t))
            elif place == "half":  # the old partitions are gone, the new ones not yet in place
                def half(store, arrived, held, changed):
                    for part in changed:
                        shutil.rmtree(f"{store.path}/latest/part={part}", ignore_errors=True)
                    lost()

                broken.setattr(incremental.ChangeStore, "_replace", half)
            else:
                broken.setattr(incremental.ChangeStore, place, lost)
            with pytest.raises(RuntimeError):
                run(spark, path, df, manifests, first)
        got = [tuple(r) for r in run(spark, path, df, manifests, first).collect()]
        want = {c for c in brute(rows, landed, runs) if c[0] <= upto}
        assert set(got) == want and len(got) == len(want)


def test_a_run_works_on_changed_partitions_only(spark):
    import os

    rows, landed, runs, df, manifests, run_df = case(spark, 3)
    path = scratch_path(spark, "t")
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/latest/") for f in fs if f.endswith(".parquet")}
    want = {tuple(r) for r in run(spark, path, df, manifests, run_df).collect()}
    before = files()
    assert {tuple(r) for r in run(spark, path, df, manifests, run_df).collect()} == want and files() == before
    # a row that came to an old file is found by the fingerprint of its partition at the next run
    late = df.unionByName(spark.createDataFrame([("k1", "v99", "zz", min(landed, key=landed.get))], df.schema))
    more = run_df.unionByName(spark.createDataFrame([(99, DAY + dt.timedelta(days=60), "done")], run_df.schema))
    got = {tuple(r) for r in run(spark, path, late, manifests.filter("landed_at < '2026-01-20'"), more).collect()}
    assert got - want >= {(99, "k1")} and len({f.split("part=")[1][:2] for f in before - files()}) < len({f.split("part=")[1][:2] for f in before}) + 1


def test_empty_inputs(spark):
    _, _, _, df, manifests, run_df = case(spark, 1)
    for a, b, c in ((df.limit(0), manifests, run_df), (df, manifests.limit(0), run_df), (df, manifests, run_df.limit(0))):
        assert run(spark, scratch_path(spark, "t"), a, b, c).count() == 0


def test_content_ignores_spelling(spark):
    df = spark.createDataFrame(
        [(1, " T ", [" A  b", None, ""], "sha256:FF"), (2, "T", ["a b", "A B"], "ff\n"), (3, "T", None, None)],
        "i int, title string, tags array<string>, payload_sha256 string",
    )
    a, b, c = [r[0] for r in df.orderBy("i").select(capture_content()).collect()]
    assert a == b != c
    assert [r[0] for r in df.orderBy("i").select(tag_set("tags")).collect()] == [["a b"], ["a b"], []]


def test_clashing_columns(spark):
    raw = spark.read.parquet(f"{SMALL}/raw_artifacts.parquet").withColumns({c: F.lit("x") for c in ("part", "version", "record_key", "_salt", "run_seq")})
    seen = spark.createDataFrame([("none", 1)], "manifest_key string, run_seq int")
    assert incremental.stage(raw, seen, "capture_id", F.col("title"), F.col("title"), F.col("source")).count() == 0
    assert p4_found(spark, SMALL).columns == ["run_seq", "capture_id"]
