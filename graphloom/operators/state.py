"""State tables on plain files: latest-wins, insert-if-absent, upsert, update, delete.

A state table is never edited. New rows are appended under a version and the newest row of a
key is the row; small tables may be written anew. Keys are assumed to be of bounded repetition
after the partial aggregate in :func:`latest`, which keeps one row a key and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``; of full ties the one with the greatest
    values, so the result does not depend on row order. Null order values come first; keys may
    be null and are then a key of their own. Columns keep their order and names.

    Max of a struct is a partial aggregate: a key that a third of all rows share is reduced to
    one row in each task before anything is sent.
    """
    comparable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in comparable if c not in order and c not in key])
    # maps have no order: they ride along by max_by, which needs one pass and the same partial form
    whole = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*key).agg(F.max_by(whole, ranked).alias("_row")).select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def absent(new: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not held, one a key (the least by all columns). Null keys count
    as equal to each other. Count the result for the number of really new rows."""
    known = held.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    # keys decide first; only rows that are really new are then reduced to one a key
    rows = new.join(known, condition, "left_anti")
    if len(new.columns) == len(key):
        return rows.distinct()
    least = rows.groupBy(*key).agg(F.min(F.struct(*[c for c in new.columns if c not in key])).alias("_row"))
    return least.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in new.columns])


def upsert(held: DataFrame, new: DataFrame, key: list[str], keep_if_null: list[str] = ()) -> DataFrame:
    """``held`` with the rows of ``new`` put in by key; a null in a ``keep_if_null`` column keeps
    what was held. Both sides must be unique by key and have the same columns."""
    values = [c for c in held.columns if c not in key]
    a = held.withColumn("_in_a", F.lit(True)).alias("a")
    b = new.withColumn("_in_b", F.lit(True)).alias("b")
    joined = a.join(b, key, "full")
    def pick(c: str) -> Column:
        old, fresh = F.col(f"a.{c}"), F.col(f"b.{c}")
        value = F.coalesce(fresh, old) if c in keep_if_null else fresh
        return F.when(F.col("b._in_b"), value).otherwise(old).alias(c)
    return joined.select(*key, *[pick(c) for c in values]).select(*held.columns)


def update(held: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """``held`` with the columns of ``changes`` set for its keys; keys not held are ignored."""
    columns = [c for c in changes.columns if c not in key]
    marked = changes.withColumn("_hit", F.lit(True)).alias("c")
    joined = held.alias("h").join(marked, key, "left")
    return joined.select(*[
        F.when(F.col("c._hit"), F.col(f"c.{c}")).otherwise(F.col(f"h.{c}")).alias(c) if c in columns else (F.col(c) if c in key else F.col(f"h.{c}"))
        for c in held.columns
    ])


def forget(held: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """``held`` without the keys given."""
    return held.join(keys.select(*key).distinct(), key, "left_anti")


def drifted(actual: DataFrame, expected: str) -> list[str]:
    """What differs between a table and its declared schema, sorted; [] if nothing does."""
    from pyspark.sql.types import StructType

    want = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(expected).fields}
    have = {f.name: f.dataType.simpleString() for f in actual.schema.fields}
    missing = [f"missing {c} {t}" for c, t in want.items() if c not in have]
    extra = [f"unexpected {c} {t}" for c, t in have.items() if c not in want]
    changed = [f"{c} is {have[c]}, not {t}" for c, t in want.items() if c in have and have[c] != t]
    return sorted(missing + extra + changed)
