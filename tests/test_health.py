import datetime as dt

from pyspark.sql import functions as F

from graphloom.operators import health
from graphloom.streaming.health import advance

START = dt.datetime(2026, 1, 1)


def log(spark, *statuses, host="h"):
    rows = [(host, n, s) for n, s in enumerate(statuses)]
    return spark.createDataFrame(rows, "host string, n int, status int")


def latched(df):
    status = F.col("status")
    return health.latches(df, "host", ["n"], health.refused(status), health.succeeded(status)).collect()


def test_three_refusals_latch_and_success_resets(spark):
    assert [r["n"] for r in latched(log(spark, 403, 404, 429, None, 500, 401, 200))] == [5]
    assert latched(log(spark, 403, 403, 200, 403)) == []
    assert latched(log(spark).limit(0)) == []


def test_backoff_doubles(spark):
    status = F.col("status")
    rows = health.backoffs(log(spark, 503, 503, 503, 503, 200, 503), "host", ["n"], health.transient(status), health.succeeded(status))
    assert [r["seconds"] for r in rows.orderBy("n").collect()] == [0, 0, 900, 1800, 0]


def test_stream_steps_agree_with_a_loop():
    import numpy as np

    rng = np.random.default_rng(3)
    columns, after = advance((False, 0, 0), np.array([503, 503, 503, 403, 403, 403, 200, 404]))
    assert columns["backoff_seconds"].tolist() == [0, 0, 900, 0, 0, 0, 0, 0] and after == (True, 0, 0)
    for _ in range(20):
        statuses = rng.choice([200, 403, 429, 503, 500, 404], 60, p=[0.1, 0.25, 0.1, 0.3, 0.15, 0.1])
        latched = refusals = failures = 0
        want = []
        for s in statuses:
            if s in (401, 403, 429):
                refusals += 1
                latched = latched or refusals >= 3
            elif s >= 500:
                failures += 1
            elif s < 400:
                refusals = failures = 0
            want.append((bool(latched), refusals, failures))
        state, got = (False, 0, 0), []
        for part in np.array_split(statuses, 7):  # as micro-batches
            columns, state = advance(state, part)
            got += list(zip(columns["latched"].tolist(), columns["refusals"].tolist(), columns["failures"].tolist(), strict=True))
        assert got == want
    assert advance((True, 2, 1), np.array([], dtype=np.int64))[1] == (True, 2, 1)


def test_cleared_host_can_latch_again(spark):
    at = spark.createDataFrame([("a", START), ("b", START), ("c", START + dt.timedelta(2))], "host string, at timestamp")
    cleared = spark.createDataFrame([("b", START), ("c", START + dt.timedelta(1))], "host string, cleared_at timestamp")
    assert {r["host"] for r in health.active_latches(at, cleared, "host", "at", "cleared_at").collect()} == {"a", "c"}
    gates = health.gate(at, at.filter("host = 'a'"), at, "host", "at", F.lit(START + dt.timedelta(1)))
    assert {r["host"]: r["verdict"] for r in gates.collect()} == {"a": "latched", "b": "open", "c": "backing_off"}


def test_dry_pages(spark):
    def pages(*new):
        return spark.createDataFrame(list(enumerate(new)), "page int, new_rows int")

    def read(*new):
        return [r["page"] for r in health.until_dry(pages(*new), "page", "new_rows").orderBy("page").collect()]

    assert read(0, 3, 0, 0, 5) == [0, 1, 2, 3]
    assert read(1, 0, 1, 0) == [0, 1, 2, 3]
    assert read(0, 0, 0) == [0, 1]
    two = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("a", 2, 5), ("b", 0, 0), ("b", 2, 0), ("b", 3, None)], "s string, page int, new_rows int")
    assert sorted((r["s"], r["page"]) for r in health.until_dry(two, "page", "new_rows", stream="s").collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 2), ("b", 3)]


def test_slices_do_not_change_streaks(spark):
    import random

    rng = random.Random(4)
    rows = [("h" if rng.random() < 0.7 else "g", n, rng.choice([403, 403, 403, 403, 200, 404])) for n in range(300)]
    df = spark.createDataFrame(rows, "host string, n int, status int")
    status = F.col("status")
    args = ("host", ["n"], health.refused(status), health.succeeded(status))
    plain = {(r["n"], r["streak"]) for r in health.streaks(df, *args).collect()}
    for width in (1, 2, 7, 50, 1000):
        assert {(r["n"], r["streak"]) for r in health.streaks(df, *args, slices=F.floor(F.col("n") / width)).collect()} == plain
    first = {tuple(r) for r in health.latches(df, *args, slices=F.floor(F.col("n") / 5)).collect()}
    assert first == {tuple(r) for r in health.latches(df, *args).collect()} and len(first) == 2
