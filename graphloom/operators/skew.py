"""Joins that hold when one key has a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more than one in HOT_SHARE of all rows; so there are fewer than
#: HOT_SHARE hot keys at any size of the data, and a list of them may be broadcast.
HOT_SHARE = 1000
SALTS = 64


def spread(*columns: Column | str, buckets: int) -> Column:
    """A bucket from the row's own values: the same when a task is run again, unlike ``rand``."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    how: str = "inner",
    hot_share: int = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``left`` with ``right``, whose ``keys`` are unique and whose ``weight`` is the
    number of left rows per key; rows of hot keys are spread over ``salts`` tasks.

    ``right`` should be stored (it is read three times). Null keys match nothing: a left row
    with one is dropped by ``inner`` and kept by ``left``. Only ``inner``, ``left`` and
    ``left_semi`` are defined. An empty ``right`` gives no hot key and the plain join.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"lookup cannot do a {how} join")
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).head()["n"]
    limit = max(1, total // hot_share)
    hot = right.filter(F.col(weight) > limit).select(*keys, F.lit(True).alias("_hot"))
    salted = right.withColumn(
        "_salt",
        F.explode(
            F.when(F.col(weight) > limit, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    ).drop(weight)
    # fewer than hot_share rows by construction, see HOT_SHARE
    marked = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread(*spread_by, buckets=salts)).otherwise(F.lit(0))
    )
    return marked.drop("_hot").join(salted, [*keys, "_salt"], how).drop("_salt")


def replicated(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner", salts: int = 8
) -> DataFrame:
    """Join a large ``left`` with a much smaller ``right`` by copying each right row ``salts``
    times; every left key, hot or not, is spread over ``salts`` tasks. Null keys as in
    :func:`lookup`."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = left.withColumn("_salt", spread(*spread_by, buckets=salts))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def small_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "left", limit: int = 100_000, size: int | None = None
) -> DataFrame:
    """Join with a table that is usually tiny: it is counted (unless its ``size`` is known), goes to
    every task up to ``limit`` rows, and beyond that is joined by salted copies. Store ``right``
    first."""
    if (right.limit(limit + 1).count() if size is None else size) <= limit:
        return left.join(F.broadcast(right), keys, how)
    return replicated(left, right, keys, spread_by, how)
