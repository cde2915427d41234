from pyspark.sql import functions as F

from graphloom.functions import text


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column("x")).collect()]


def test_strip_and_squeeze(spark):
    assert one(spark, text.strip, " a　\n", None, "", " \t ") == ["a", None, "", ""]
    assert one(spark, text.squeeze, " A   b\t") == ["a b"]


def test_hashes_and_times(spark):
    assert one(spark, text.normal_hash, " SHA256:AB\n", "", None, "ab") == ["ab", None, None, "ab"]
    assert one(spark, text.seconds_text, "2026-01-02T03:04:05.99+00:00", "2026-01-02", None, "2026-01-02 03:04:05Z") == [
        "2026-01-02 03:04:05", None, None, "2026-01-02 03:04:05",
    ]


def test_repositories(spark):
    assert one(spark, text.normal_repo, "https://www.H.example/A/b.git/", "h.example/a/B.git", "", None) == ["h.example/a/b", "h.example/a/b", "", ""]


def test_keys_and_errors(spark):
    row = spark.range(1).select(
        text.blob_key(F.lit("abcd"), F.lit("prefix")).alias("b"), text.error_text(F.lit("x" * 600)).alias("e"), text.error_text(F.lit("")).alias("n"),
        text.manifest_key(F.lit("s"), F.lit("2026-03-01").cast("timestamp"), F.lit("r"), F.lit(7)).alias("m"),
    ).head()
    assert row["b"] == "blob/ab/abcd.bin.gz" and len(row["e"]) == 500 and row["n"] is None
    assert row["m"] == "raw/s/2026-03/r-0007.jsonl.gz"


def test_backoff(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 60)], "n int")
    assert [r[0] for r in df.select(text.backoff_seconds(F.col("n"))).collect()] == [0, 0, 900, 1800, 3600, 86400]


def test_total_size(spark):
    rows = [("bytes 0-9/1234", None, 206), (None, "77", 200), (None, "77", 206), ("bytes 0-9/*", None, 206), ("junk", "x", 200)]
    df = spark.createDataFrame(rows, "r string, l string, s int")
    assert [r[0] for r in df.select(text.total_size("r", "l", "s")).collect()] == [1234, 77, None, None, None]
