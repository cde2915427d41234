"""Schemas that drift between files: versions, changes, and one consistent table.

A schema is the set of (field, type) that the records of one source hold in one month. Its
fingerprint makes versions comparable; the difference of neighbouring versions is a list of
explicit steps (added, removed, retyped, renamed); the steps, chained, route each record of
any month to the newest names and types.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.jsontext import clean, decode_object, fields, kind, plain, value_text
from graphloom.functions.text import strip
from graphloom.operators.skew import small_join
from graphloom.sources.shared import materialize

MONTH = r"/(\d{4}-\d{2})/"
FLAT = "source string, month string, capture_id string, workflow_id string, fields array<struct<field: string, type: string, value: string>>"
UNIFIED = (
    "source string, month string, capture_id string, fields map<string, string>, renamed int, cast int, defaulted int, "
    "uncast int, conflicts int"
)


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep: list[int] = []
        ends, names, types, values = [0], [], [], []
        for at, meta in enumerate(batch.column(4).to_pylist()):
            obj = decode_object(meta)
            if obj is None:
                continue
            keep.append(at)
            for field, value in fields(obj):
                names.append(clean(field))
                types.append(kind(value))
                values.append(None if types[-1] == "array" else value_text(value))
            ends.append(len(names))
        columns = [pa.array(c, pa.string()) for c in (names, types, values)]
        items = pa.StructArray.from_arrays(columns, names=["field", "type", "value"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
        rest = batch.select([0, 1, 2, 3]).take(pa.array(keep, pa.int32()))
        yield pa.RecordBatch.from_arrays([*rest.columns, lists], names=["source", "month", "capture_id", "workflow_id", "fields"])


def flatten(raw: DataFrame) -> DataFrame:
    """The fields of each readable ``source_meta``, one row a record. Records whose meta is
    null, blank, broken or not an object, and those without source or month, are left out."""
    return (
        raw.select(
            "source", F.regexp_extract("manifest_key", MONTH, 1).alias("month"), "capture_id",
            F.coalesce("workflow_id", F.lit("")).alias("workflow_id"), "source_meta",
        )
        .filter((F.col("month") != "") & F.col("source").isNotNull() & F.col("source_meta").isNotNull())
        .mapInArrow(_flatten, FLAT)
    )


def field_types(flat: DataFrame) -> DataFrame:
    """(source, month, field, types): types sorted. One row a field and month: catalogue size."""
    return (
        flat.select("source", "month", F.explode("fields").alias("f"))
        .groupBy("source", "month", F.col("f.field").alias("field"))
        .agg(F.array_sort(F.collect_set("f.type")).alias("types"))
    )


def versions(types: DataFrame) -> DataFrame:
    """(source, month, n_fields, fingerprint, version): the version goes up by one whenever the
    fingerprint differs from that of the month before."""
    prints = types.groupBy("source", "month").agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.md5(F.to_json(F.array_sort(F.collect_list(F.struct("field", "types"))))).alias("fingerprint"),
    )
    order = Window.partitionBy("source").orderBy("month")
    moved = (~F.col("fingerprint").eqNullSafe(F.lag("fingerprint").over(order))).cast("int")
    return prints.withColumn("moved", moved).withColumn("version", F.sum("moved").over(order).cast("int")).drop("moved")


def _steps(types: DataFrame) -> DataFrame:
    """(source, step, before): each month whose schema has another fingerprint than that of the month
    before. Months of one schema version need no step and are not compared field by field."""
    order = Window.partitionBy("source").orderBy("month")
    return (
        versions(types)
        .withColumns({"before": F.lag("month").over(order), "held": F.lag("fingerprint").over(order)})
        .filter(F.col("before").isNotNull() & (F.col("held") != F.col("fingerprint")))
        .select("source", F.col("month").alias("step"), "before")
    )


def differences(types: DataFrame) -> DataFrame:
    """(source, step, before, field, drift): added, removed and retyped fields, renames not yet
    told apart."""
    months = _steps(types)
    old = types.withColumnRenamed("month", "before").withColumnRenamed("types", "old_types").join(months, ["source", "before"])
    new = types.withColumnRenamed("month", "step").withColumnRenamed("types", "new_types").join(months, ["source", "step"])
    both = old.join(new, ["source", "step", "before", "field"], "full")
    drift = (
        F.when(F.col("new_types").isNull(), "removed")
        .when(F.col("old_types").isNull(), "added")
        .when(F.col("old_types") != F.col("new_types"), "retyped")
    )
    return both.withColumn("drift", drift).filter(F.col("drift").isNotNull()).select("source", "step", "before", "field", "drift")


def renames(flat: DataFrame, differing: DataFrame) -> DataFrame:
    """(source, step, old_field, new_field): a field that went and one that came, with equal
    values in every pair of an earlier and a later row of one capture and workflow that hold
    both, and at least one such pair.

    ``differing`` should be stored. All values of a record in a month are first reduced to their least and greatest; all pairs
    agree just when those four are one value. So repeated rows add no pairs.
    """
    def side(drift: str, month: str, name: str) -> DataFrame:
        wanted = differing.filter(F.col("drift") == drift).select("source", "step", F.col(month).alias("month"), "field")
        values = flat.filter(F.col("capture_id").isNotNull()).select(
            "source", "month", "capture_id", "workflow_id", F.explode("fields").alias("f")
        ).filter(F.col("f.value").isNotNull()).select("source", "month", "capture_id", "workflow_id", "f.field", "f.value")
        return (
            small_join(values, wanted, ["source", "month", "field"], ["capture_id"], "inner")
            .groupBy("source", "step", "capture_id", "workflow_id", F.col("field").alias(f"{name}_field"))
            .agg(F.min("value").alias(f"{name}_least"), F.max("value").alias(f"{name}_most"))
        )

    pairs = side("removed", "before", "old").join(side("added", "step", "new"), ["source", "step", "capture_id", "workflow_id"])
    same = (F.col("old_least") == F.col("new_least")) & (F.col("old_most") == F.col("new_most")) & (F.col("old_least") == F.col("old_most"))
    return (
        pairs.groupBy("source", "step", "old_field", "new_field").agg(F.min(same.cast("int")).alias("same"))
        .filter("same = 1").drop("same")
    )


def changes(flat: DataFrame) -> DataFrame:
    """(source, step, old_field, new_field, drift): every change between neighbouring months.
    ``flat`` should be stored, it is read several times."""
    types = materialize(field_types(flat), "types")  # both the fingerprints and the differences read it
    differing = materialize(differences(types), "differences")
    renamed = materialize(renames(flat, differing), "renames")
    gone = renamed.select("source", "step", F.col("old_field").alias("field"), F.lit("removed").alias("drift"))
    come = renamed.select("source", "step", F.col("new_field").alias("field"), F.lit("added").alias("drift"))
    plain_ones = differing.join(gone.union(come), ["source", "step", "field", "drift"], "left_anti").select(
        "source", "step",
        F.when(F.col("drift") == "added", F.lit("")).otherwise(F.col("field")).alias("old_field"),
        F.when(F.col("drift") == "removed", F.lit("")).otherwise(F.col("field")).alias("new_field"),
        "drift",
    )
    return plain_ones.unionByName(renamed.withColumn("drift", F.lit("renamed"))).distinct()


def notation(column: Column) -> Column:
    """The shape of a value: stripped, each run of digits replaced by 9."""
    return F.regexp_replace(strip(column), "[0-9]+", "9")


def reshaped(rows: DataFrame, table: str, batch: str, columns: list[str]) -> DataFrame:
    """Changes of notation: a row for each batch in which the set of shapes of a column's
    non-blank values is not that of the batch before. Null batches are left out."""
    each = rows.filter(F.col(batch).isNotNull()).select(
        F.col(batch).alias("batch"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), notation(F.col(c)).alias("shape")) for c in columns])).alias("f"),
    )
    shapes = each.groupBy("batch", F.col("f.field").alias("field")).agg(
        F.array_sort(F.collect_set(F.when(F.col("f.shape") != "", F.col("f.shape")))).alias("shapes")
    )
    order = Window.partitionBy("field").orderBy("batch")
    return (
        shapes.withColumn("before", F.lag("shapes").over(order))
        .filter(F.col("before").isNotNull() & (F.col("before") != F.col("shapes")))
        .select(
            F.lit(table).alias("source"), F.lpad(F.col("batch").cast("string"), 2, "0").alias("step"),
            F.col("field").alias("old_field"), F.col("field").alias("new_field"), F.lit("reshaped").alias("drift"),
        )
    )


def _one_type(types: list[str]) -> str:
    return types[0] if len(types) == 1 else "string"


class MigrationPlan:
    """Rename and type rules, chained by month. The rules are a catalogue of changes, not of
    records; more than ``limit`` of them is refused rather than sent to every executor."""

    def __init__(self, change_list: DataFrame, types: DataFrame, limit: int = 200_000):
        newest = types.withColumn("last", F.max("month").over(Window.partitionBy("source"))).filter(F.col("month") == F.col("last"))
        rules = change_list.filter("drift = 'renamed'").select("source", "step", "old_field", "new_field").limit(limit + 1).collect()
        target = newest.select("source", "field", "types").limit(limit + 1).collect()
        history = types.select("source", "month", "field", "types").limit(limit + 1).collect()
        if max(len(rules), len(target), len(history)) > limit:
            raise ValueError(f"more than {limit} rules; plan each source by itself")
        self.renames: dict[str, list[tuple[str, str, str]]] = {}
        for r in sorted(rules):
            self.renames.setdefault(r["source"], []).append((r["step"], r["old_field"], r["new_field"]))
        self.target: dict[str, dict[str, str]] = {}
        for r in target:
            self.target.setdefault(r["source"], {})[r["field"]] = _one_type(r["types"])
        # the types of a field by month; the end of this chain is what its values are cast to
        self.casts: dict[str, dict[str, str]] = {}
        for r in sorted(history, key=lambda r: r["month"]):
            self.casts.setdefault(r["source"], {})[r["field"]] = _one_type(r["types"])
        #: The default rule of each field of the newest schema: present, without a value.
        self.defaults: dict[str, dict[str, str | None]] = {source: dict.fromkeys(fields) for source, fields in self.target.items()}

    def names(self, source: str, month: str) -> dict[str, str]:
        """Newest name by the name that a record of ``month`` has."""
        to: dict[str, str] = {}
        back: dict[str, list[str]] = {}
        for step, old, new in self.renames.get(source, []):
            if step > month:
                for first in back.pop(old, [old]):
                    to[first] = new
                    back.setdefault(new, []).append(first)
        return to


def cast_text(value, to: str) -> tuple[str, bool]:
    """A value as text of the type wanted, and whether that took a cast. A value that cannot
    be of that type keeps its text."""
    if kind(value) == to or to == "string" and isinstance(value, str):
        return plain(value), False
    if to == "number" and isinstance(value, str):
        try:
            number = float(value)
            return (str(int(value)) if value.strip().lstrip("+-").isdigit() else repr(number)), True
        except ValueError:
            return plain(value), False
    if to == "boolean" and isinstance(value, str) and value.strip().lower() in ("true", "false"):
        return value.strip().lower(), True
    return plain(value), True


def unify(raw: DataFrame, plan: MigrationPlan, defaults: dict[str, str] | None = None) -> DataFrame:
    """Every readable record under the newest names and types of its source: fields as a map
    from name to text, with the number of renames, casts and defaults applied to it. A name
    that the newest month does not have stays and has the type of the last month with it; a
    name it has and the record has not gets its value in ``defaults``, if given there, or else,
    without ``defaults``, by the plan: null. ``uncast`` counts values that cannot be of the type
    wanted and keep their text. Where several fields of a record come to one name with different
    values the one that has it already (or else the first by its old name) takes it, each other
    stays under its old name and counts in ``conflicts``. Unreadable records are left out."""
    fallback = None if defaults is None else dict(defaults)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], dict[str, str]] = {}
        schema = pa.schema([
            ("source", pa.string()), ("month", pa.string()), ("capture_id", pa.string()),
            ("fields", pa.map_(pa.string(), pa.string())),
            *((c, pa.int32()) for c in ("renamed", "cast", "defaulted", "uncast", "conflicts")),
        ])
        for batch in batches:
            rows = []
            for source, month, capture, meta in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                obj = decode_object(meta)
                if obj is None:
                    continue
                if (source, month) not in known:
                    known[source, month] = plan.names(source, month)
                names, target, casting = known[source, month], plan.target.get(source, {}), plan.casts.get(source, {})
                out: dict[str, str] = {}
                moved = casts = failed = conflicts = 0
                given = [(names.get(f, f), f, value) for f, value in ((clean(f), v) for f, v in fields(obj))]
                # fields that have their newest name already come first, then the renamed ones by name
                for name, field, value in sorted(given, key=lambda g: (g[0] != g[1], g[1])):
                    to = casting.get(name, kind(value))
                    text, changed = cast_text(value, to)
                    if name in out and out[name] != text:
                        conflicts += 1
                        name = field
                        while name in out:
                            name += "'"
                    moved += name != field
                    casts += changed
                    failed += not changed and kind(value) != to
                    out[name] = text
                filled = {k: v for k, v in (plan.defaults.get(source, {}) if fallback is None else fallback).items() if k in target and k not in out}
                rows.append((source, month, capture, list((out | filled).items()), moved, casts, len(filled), failed, conflicts))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return (
        raw.select("source", F.regexp_extract("manifest_key", MONTH, 1).alias("month"), "capture_id", "source_meta")
        .filter((F.col("month") != "") & F.col("source").isNotNull() & F.col("source_meta").isNotNull())
        .mapInArrow(route, UNIFIED)
    )


#: A version: v or not, one to three numbers, and what stands behind them (such as ``-rc.1``).
VERSION = r"^[vV]?([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?([-+].*)?$"


def version_text(column: Column | str) -> Column:
    """A version as three numbers without v, missing ones 0; a suffix such as ``-rc.1`` is part of
    the value and stays. What is no version stays as it is, stripped; null for blank."""
    bare = strip(column)
    part = lambda n: F.regexp_extract(bare, VERSION, n)
    number = lambda n: F.when(part(n) == "", "0").otherwise(part(n))
    return F.when(bare.rlike(VERSION), F.concat(F.concat_ws(".", number(1), number(2), number(3)), part(4))).when(bare != "", bare)


def unify_versions(rows: DataFrame, table: str, batch: str, key: str, columns: list[str]) -> DataFrame:
    """All rows of a table with ``columns`` in one notation, in the form of :func:`unify`: month is
    the batch in two digits, capture_id the row's key; blanks get the default null."""
    new = {c: version_text(c) for c in columns}
    count = lambda conditions: sum((c.cast("int") for c in conditions), F.lit(0))
    return rows.select(
        F.lit(table).alias("source"), F.lpad(F.col(batch).cast("string"), 2, "0").alias("month"), F.col(key).alias("capture_id"),
        F.create_map(*[x for c in columns for x in (F.lit(c), new[c])]).alias("fields"), F.lit(0).alias("renamed"),
        count(F.coalesce(new[c] != F.col(c), F.lit(False)) for c in columns).alias("cast"), count(new[c].isNull() for c in columns).alias("defaulted"),
        count(F.coalesce(~new[c].rlike(VERSION), F.lit(False)) for c in columns).alias("uncast"), F.lit(0).alias("conflicts"),
    )
