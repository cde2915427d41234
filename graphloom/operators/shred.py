"""Deeply nested records as flat tables with keys, by shared inlining.

First the schema graph is measured over all records: which element type stands in which, how
often, and whether several times in one parent. From it the layout follows: an element that is
repeated, shared by several parents or recursive gets a table of its own; any other is inlined
into the nearest ancestor that has one. Then each record is walked once more and every element
with a table gives a row: its key, the key of the row it stands in, and its fields with those of
the elements inlined into it. No list of tables is written down anywhere; a type of element that
was never seen before gets its table, or is inlined, by the same rules.

Types are named by the field they stand under and the type they stand in. A field whose name is
already among the names on its way is the same type again, so recursion ends; keys that are
numbers or digests are entries of a map and share one name. Graph documents have types by what
they are, wherever they stand: save_graph, api_graph, and in these node, api_node, definitions
and subgraph.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import ChainMap, Counter
from collections.abc import Collection, Iterator, Mapping
from functools import lru_cache
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.jsontext import clean, decode, decode_object, plain
from graphloom.operators.skew import lookup
from graphloom.sources.shared import materialize, measured

EDGES = "parent string, child string, records bigint, occurrences bigint, repeated boolean"
#: Columns of every row: the table it belongs to and its key, the row it stands in, its key in a map,
#: and the enclosing graph and subgraphs.
KEYS = (
    "table_name", "capture_id", "row_id", "parent_table", "parent_id", "entry_key", "graph", "graph_id", "parent_subgraph_id", "subgraph_id",
)
#: Pairs of types up to which the driver makes the layout and tasks have all of it. Of more pairs it is
#: made by joins; this many types, the most frequent, are then sent to tasks, the others joined.
LAYOUT_EDGES = 20_000
GRAPH_KINDS = {"save_graph": "workflow", "api_graph": "prompt"}
#: Elements that are no graph by themselves, whatever they hold.
_PARTS = frozenset(("definitions", "subgraph", *GRAPH_KINDS))
#: A dot between two names; one that is part of a name has a backslash before it.
_NAMES = re.compile(r"(?<!\\)\.")
_ENTRY = re.compile(r"\d+(?:[.:_-]\d+)*|[0-9a-fA-F]{8}[0-9a-fA-F-]*")


class Place(NamedTuple):
    """The graph and subgraph that an element stands in."""

    graph: str = ""
    graph_at: str = ""
    parent_subgraph: str = ""
    subgraph: str = ""


class Element(NamedTuple):
    obj: dict
    type: str
    parent: str
    parent_at: str
    at: str
    key: str
    many: bool
    place: Place


def graph_type(obj: dict) -> str | None:
    """What graph an object is: with an array ``nodes``, or without ``nodes`` and with a value that is
    an object with a class_type; None for neither."""
    if "nodes" in obj:
        return "save_graph" if isinstance(obj["nodes"], list) else None
    for value in obj.values():
        if isinstance(value, dict) and "class_type" in value:
            return "api_graph"
    return None


def embedded(text: str) -> Any:
    """What a text value holds if it is the JSON of an object or array, however often encoded: each
    decoding makes it shorter, so this ends."""
    while True:
        if text.lstrip()[:1] not in ("{", "[", '"'):
            return None
        value = decode(text)
        if not isinstance(value, str):
            return value if isinstance(value, (dict, list)) else None
        text = value


def _objects(value: Any, at: str) -> Iterator[tuple[dict, str, bool, int]]:
    """(object, place, whether written as an object and not as text, depth of lists) of the objects
    that a value is or holds in its lists."""
    todo = [(value, at, True, 0)]
    while todo:
        value, at, plainly, depth = todo.pop()
        if isinstance(value, str):
            value, at, plainly = embedded(value), at + "!", False
        if isinstance(value, dict):
            yield value, at, plainly, depth
        elif isinstance(value, list):
            todo += [(item, f"{at}[{n}]", plainly, depth + 1) for n, item in enumerate(value) if isinstance(item, (dict, list, str))]


def _may_hold(text: str) -> bool:
    return text[:1] in ("{", "[", '"') or text[:1].isspace()


def _role(kind: str, field: str, depth: int) -> str | None:
    """The type that an object has as a part of a graph document."""
    if kind in ("save_graph", "subgraph"):
        if field == "nodes" and depth == 1:
            return "node"
        if field == "definitions" and depth == 0:
            return "definitions"
    elif kind == "definitions" and field == "subgraphs" and depth == 1:
        return "subgraph"
    elif kind == "api_graph" and depth == 0:
        return "api_node"
    return None


@lru_cache(maxsize=1 << 16)
def child_type(parent: str, field: str, plainly: bool, depth: int) -> str:
    """Type of an object under a field of a parent type, if it is no graph. ``plainly``: it is written
    as an object and not as text; ``depth``: of the lists it stands in."""
    role = _role(parent, field, depth) if plainly else None
    if role is not None:
        return role
    name = "*" if _ENTRY.fullmatch(field) else clean(field).replace("\\", "/").replace(".", "\\.")
    name += "[]" if depth else ""
    ends = [m.start() for m in _NAMES.finditer(parent)] + [len(parent)]
    for start, end in itertools.pairwise(ends):
        if parent[start + 1 : end] == name:
            return parent[:end]
    return f"{parent}.{name}"


def children(parent: Element) -> Iterator[Element]:
    """The elements that stand directly in one."""
    above, at = parent.type, parent.at
    own = None if above in _PARTS else graph_type(parent.obj)
    if own:  # a node, an entry or the record itself can be a graph as well
        yield Element(parent.obj, own, above, at, at + "@", "", False, Place(GRAPH_KINDS[own], at + "@"))
        return
    for field, value in parent.obj.items():
        held: Any
        if isinstance(value, dict):
            held = ((value, f"{at}.{field}", True, 0),)
        elif isinstance(value, str):
            if not _may_hold(value):
                continue
            held = _objects(value, f"{at}.{field}")
        elif isinstance(value, list):
            if not any(isinstance(item, dict) or isinstance(item, list) or isinstance(item, str) and _may_hold(item) for item in value):
                continue
            held = _objects(value, f"{at}.{field}")
        else:
            continue
        for obj, here, plainly, depth in held:
            kind, place = child_type(above, field, plainly, depth), parent.place
            if kind == "subgraph":
                place = Place(place.graph, place.graph_at, place.subgraph, plain(obj.get("id")))
            elif kind not in ("node", "definitions", "api_node"):
                graph = graph_type(obj)
                if graph is not None:
                    yield Element(obj, graph, above, at, here, field, depth > 0, Place(GRAPH_KINDS[graph], here))
                    continue
            yield Element(obj, kind, above, at, here, field, depth > 0 or kind == "api_node" or kind.endswith("*"), place)


def elements(record: dict) -> Iterator[Element]:
    """All elements of a decoded record, the record itself first; nesting has no limit."""
    todo = [Element(record, "capture", "", "", "", "", False, Place())]
    while todo:
        element = todo.pop()
        yield element
        todo += children(element)


def graphs(record: dict) -> Iterator[tuple[str, str, dict]]:
    """(kind, place, object) of each graph at any depth of a decoded record and of the JSON texts in
    it; a subgraph is part of its graph and not a graph itself."""
    for element in elements(record):
        if element.type in GRAPH_KINDS:
            yield GRAPH_KINDS[element.type], element.at, element.obj


# --- the schema graph and the layout --------------------------------------------------------


class Layout(dict):
    """For each element type the table that holds it. Beyond LAYOUT_EDGES the most frequent types are
    here and ``everything`` is the table of all, in which a lookup of another one goes on."""

    everything: DataFrame | None = None

    def __missing__(self, name: str) -> str:
        row = None if self.everything is None else self.everything.filter(F.col("element") == name).select("table_name").head()
        if row is None:
            raise KeyError(name)
        return row["table_name"]

    def get(self, name: str, default: Any = None) -> Any:
        try:
            return self[name]
        except KeyError:
            return default


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records: Counter = Counter()
        occurrences: Counter = Counter()
        many: set = set()
        for meta in batch.column(0).to_pylist():
            record = decode_object(meta)
            if record is None:
                continue
            own: Counter = Counter()
            for element in elements(record):
                edge = (element.parent, element.type)
                own[edge] += 1
                if element.many:
                    many.add(edge)
            occurrences.update(own)
            records.update(own.keys())
        keys = list(occurrences)
        yield pa.RecordBatch.from_pydict(
            {
                "parent": [k[0] for k in keys], "child": [k[1] for k in keys], "records": [records[k] for k in keys],
                "occurrences": [occurrences[k] for k in keys], "repeated": [k in many for k in keys],
            },
            pa.schema([("parent", pa.string()), ("child", pa.string()), ("records", pa.int64()), ("occurrences", pa.int64()), ("repeated", pa.bool_())]),
        )


def schema_graph(raw: DataFrame) -> DataFrame:
    """The edges between element types over all records: (parent, child, records, occurrences,
    repeated). One row for each pair of types; '' is the parent of the record itself."""
    return (
        raw.select("source_meta").filter(F.col("source_meta").isNotNull()).mapInArrow(_measure, EDGES)
        .groupBy("parent", "child")
        .agg(F.sum("records").alias("records"), F.sum("occurrences").alias("occurrences"), F.max("repeated").alias("repeated"))
    )


def layout(edges: list[tuple[str, str, bool]]) -> dict[str, str]:
    """For each element type the table that holds it, from (parent, child, repeated) edges: itself if
    it is a root, repeated, shared or recursive, else that of its only parent."""
    parents: dict[str, list[tuple[str, bool]]] = {}
    below: dict[str, list[str]] = {}
    names = {n for e in edges for n in e[:2] if n}
    for parent, child, repeated in edges:
        if parent:
            parents.setdefault(child, []).append((parent, repeated))
            below.setdefault(parent, []).append(child)

    def recursive(start: str) -> bool:
        seen: set[str] = set()
        todo = list(below.get(start, ()))
        while todo:
            if (x := todo.pop()) not in seen:
                seen.add(x)
                todo += below.get(x, ())
        return start in seen

    # with one parent each, only what stands in itself can be recursive and not shared
    own = {n for n in names if n not in parents or len(parents[n]) > 1 or any(r or p == n for p, r in parents[n])}
    own |= {n for n in names - own if recursive(n)}

    def holder(name: str) -> str:
        while name not in own:
            name = parents[name][0][0]
        return name

    return {n: holder(n) for n in sorted(names)}


def _batch(rows: Collection[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (type, least length) the types on the way to it that are as long as that, and itself, as digests."""
    schema = pa.schema([("key", pa.binary()), ("way", pa.binary()), ("length", pa.int32())])
    for batch in batches:
        rows: list[tuple[bytes, bytes, int]] = []
        for name, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key, way, at = hashlib.md5(name.encode()).digest(), hashlib.md5(), 0
            for end in [*(m.start() for m in _NAMES.finditer(name)), len(name)]:
                way.update(name[at:end].encode())
                at = end
                if end >= least:
                    rows.append((key, way.digest(), end))
            if len(rows) > 100_000:
                yield _batch(rows, schema)
                rows = []
        if rows:
            yield _batch(rows, schema)


def joined_layout(edges: DataFrame) -> DataFrame:
    """What :func:`layout` gives, for any number of edges: (element, table_name, inlined, parents,
    occurrences), made by joins. A type with a dot in its name stands in the type before its last
    name, and else only in types below itself or itself; the few without a dot are the roots of all
    names. So a circle goes back to a type on the way to another, or through roots, and what is on
    it are types on the ways to the parents where it closes."""
    dotted = lambda c: F.instr(c, ".") > 0
    root = lambda c: F.substring_index(c, ".", 1)
    inner = edges.filter("parent <> ''")
    across = inner.filter(~dotted("child")).withColumn("step", F.concat(root("parent"), F.lit(" "), "child"))
    steps = {tuple(r["step"].split(" ")) for r in across.select("step").distinct().collect()}  # pairs of roots
    reach = {n: {n} for step in steps for n in step}
    while any(not reach[b] <= reach[a] for a, b in steps):
        for a, b in steps:
            reach[a] |= reach[b]
    closing = [f"{a} {b}" for a, b in steps if a in reach[b]]
    back = inner.filter(dotted("child") & (F.length("child") <= F.length("parent"))).select("parent", F.length("child").alias("least"))
    circles = back.unionByName(across.filter(F.col("step").isin(closing)).select("parent", F.lit(0).alias("least")))
    ways = "key binary, way binary, length int"
    recursive = circles.groupBy("parent").agg(F.min("least").alias("least")).mapInArrow(_ways, ways).select(F.col("way").alias("key")).distinct()
    inside = F.col("parent") != ""
    found = edges.groupBy(F.col("child").alias("element")).agg(
        F.array_sort(F.collect_list(F.when(inside, F.col("parent")))).alias("parents"), F.sum("occurrences").alias("occurrences"),
        F.coalesce(F.max(F.when(inside, F.col("repeated"))), F.lit(False)).alias("repeated"),
    ).withColumn("key", F.unhex(F.md5("element")))
    types = materialize(
        found.join(recursive.withColumn("recursive", F.lit(True)), "key", "left")
        .withColumn("own", (F.size("parents") != 1) | F.col("repeated") | F.coalesce("recursive", F.lit(False))).drop("repeated", "recursive"),
        "types",
    )
    # an inlined type is held by the longest type on its way that has a table, or by what holds its root
    inlined = types.filter(~F.col("own"))
    roots = {r["element"]: r["parents"][0] for r in inlined.filter(~dotted("element")).select("element", "parents").collect()}
    above = inlined.filter(dotted("element")).select("element", (F.length(root("element")) + 1).alias("least")).mapInArrow(_ways, ways)
    near = above.join(types.filter("own").select(F.col("key").alias("way")), "way").groupBy("key").agg(F.max("length").alias("near"))
    name = F.when(F.col("own"), F.col("element")).otherwise(F.expr("substring(element, 1, near)"))
    held = types.join(near, "key", "left").withColumn("table_name", name)
    known = {r["element"]: r["table_name"] for r in held.filter(F.col("element").isin(list(roots.values()))).select("element", "table_name").collect()}

    def holder(name: str) -> str:
        while name in roots:
            parent = roots[name]
            name = known[parent] or parent.split(".")[0]
        return name

    table = F.coalesce("table_name", *(F.when(root("element") == n, F.lit(holder(n))) for n in roots), root("element"))
    return held.withColumn("table_name", table).select("element", "table_name", (F.col("element") != F.col("table_name")).alias("inlined"), "parents", "occurrences")


def measured_layout(raw: DataFrame) -> Layout:
    """The layout of all records."""
    edges, count = measured(schema_graph(raw), "edges")
    if count <= LAYOUT_EDGES:
        return Layout(layout([(r["parent"], r["child"], bool(r["repeated"])) for r in edges.collect()]))
    everything = materialize(joined_layout(edges).drop("parents"), "layout")
    frequent = everything.orderBy(F.desc("occurrences"), "element").limit(LAYOUT_EDGES).collect()
    held = Layout((r["element"], r["table_name"]) for r in frequent)
    held.everything = everything
    return held


def describe(raw: DataFrame) -> DataFrame:
    """The schema graph with the layout that follows from it: (element, table_name, inlined, parents,
    occurrences)."""
    stored, count = measured(schema_graph(raw), "edges")
    if count > LAYOUT_EDGES:
        return joined_layout(stored)
    edges = stored.collect()
    holders = layout([(r["parent"], r["child"], bool(r["repeated"])) for r in edges])
    above: dict[str, list[str]] = {}
    counts: Counter = Counter()
    for r in edges:
        above.setdefault(r["child"], []).append(r["parent"])
        counts[r["child"]] += r["occurrences"]
    rows = [(e, t, e != t, sorted(p for p in above.get(e, ()) if p), counts[e]) for e, t in holders.items()]
    return raw.sparkSession.createDataFrame(rows, "element string, table_name string, inlined boolean, parents array<string>, occurrences bigint")


# --- rows -----------------------------------------------------------------------------------


def fields(element: Element, holders: Mapping[str, str]) -> dict[str, str]:
    """The values of an element and of all that is inlined into it, by dotted path: texts as they are,
    other values as JSON, of an array what is no object. Null values have none."""
    out: dict[str, str] = {}
    todo = [("", element)]
    while todo:
        prefix, current = todo.pop()
        for field, value in current.obj.items():
            if value is None:
                continue
            name = prefix + clean(field)
            if isinstance(value, (dict, list, str)):
                objects = list(_objects(value, ""))
                for obj, at, plainly, depth in objects:
                    kind = child_type(current.type, field, plainly, depth)
                    if kind not in _PARTS and holders.get(kind) != kind and graph_type(obj) is None:
                        todo.append((f"{name}{clean(at)}.", current._replace(obj=obj, type=kind)))
                if isinstance(value, dict) or isinstance(value, str) and objects and not objects[0][3]:
                    continue
                if isinstance(value, list):
                    value = [item for item in value if not isinstance(item, dict)]
                    if objects and not value:
                        continue
            while name in out:  # a field name with a dot in it can read like a path
                name += "'"
            out[name] = plain(value)
    return out


def pick(element: Element, path: str, holders: Mapping[str, str]) -> str:
    """One value of :func:`fields`, '' if there is none, without looking at the others."""
    obj, kind = element.obj, element.type
    *way, last = path.split(".")
    for field in way:
        inner = obj.get(field)
        if not isinstance(inner, dict):
            return ""
        kind = child_type(kind, field, True, 0)
        if holders.get(kind) == kind:
            return ""
        obj = inner
    return plain(obj.get(last))


def record_rows(
    meta: str | None, holders: Mapping[str, str], wanted: dict[str, list[str] | None] | None = None, strict: bool = False
) -> Iterator[tuple[str, ...]]:
    """(table_name, row_id, parent_table, parent_id, entry_key, graph, graph_id, parent_subgraph_id,
    subgraph_id, fields) of each element with a table; see :func:`shred`. None if unreadable.
    ``strict``: a type that the layout does not have is a LookupError."""
    record = decode_object(meta)
    if record is None:
        return
    digest = hashlib.md5(meta.encode("utf-8", "surrogatepass")).hexdigest()
    above: dict[str, tuple[str, str]] = {}  # by place the nearest row, for what is inlined
    for element in elements(record):
        kind, place = element.type, element.place
        holding = above.get(element.parent_at, ("", ""))
        if (holder := holders.get(kind)) != kind:
            if strict and holder is None:
                raise LookupError(kind)
            above[element.at] = holding
            continue
        above[element.at] = (kind, element.at)
        if wanted is not None and kind not in wanted:
            continue
        names = wanted[kind] if wanted is not None else None
        values = fields(element, holders) if names is None else {n: pick(element, n, holders) for n in names}
        yield (
            kind, digest + clean(element.at), holding[0], digest + clean(holding[1]) if holding[0] else "", clean(element.key), place.graph,
            digest + clean(place.graph_at) if place.graph else "", place.parent_subgraph, place.subgraph, tuple(values.items()),
        )


def _rows(
    metas: DataFrame, holders: dict[str, str], wanted: dict[str, list[str] | None] | None, columns: tuple[str, ...], strict: bool = False
) -> DataFrame:
    """Rows of records (capture_id, source_meta, and if need be the further types that have tables);
    ``strict`` leaves out records with a type that ``holders`` does not have."""
    order = [c for c in KEYS if c != "capture_id"]
    at = [order.index(c) for c in columns if c != "capture_id"]
    named = [c for c in columns if c != "capture_id"]
    ddl = ", ".join(["capture_id string", *(f"{c} string" for c in named), "fields map<string,string>"])
    schema = pa.schema([("capture_id", pa.string()), *((c, pa.string()) for c in named), ("fields", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, None] = {}
            for capture, meta, *further in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = ChainMap({t: t for t in further[0]}, holders) if further else holders
                made = record_rows(meta, held, wanted, strict)
                if strict:
                    try:
                        made = iter(list(made))
                    except LookupError:
                        continue
                for row in made:
                    rows[(capture, *[row[n] for n in at], row[-1])] = None
                if len(rows) > 100_000:
                    yield _batch(rows, schema)
                    rows = {}
            if rows:
                yield _batch(rows, schema)

    return metas.mapInArrow(run, ddl).select(*columns, "fields")


def _with_further(metas: DataFrame, common: dict[str, str], everything: DataFrame) -> DataFrame:
    """The records with a type that is not among the common ones, and those of these types that have
    tables: types go by record to the table of all, and back to the record by its digest."""
    schema = pa.schema([("capture_id", pa.string()), ("source_meta", pa.string()), ("types", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[tuple] = []
            for capture, meta in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = decode_object(meta)
                types = {e.type for e in elements(record)}.difference(common) if record is not None else ()
                if types:
                    kept.append((capture, meta, sorted(types)))
            if kept:
                yield _batch(kept, schema)

    marked = metas.mapInArrow(run, "capture_id string, source_meta string, types array<string>")
    marked = materialize(marked.withColumn("key", F.unhex(F.md5("source_meta"))), "beyond")
    texts = marked.groupBy("key").agg(F.first("types").alias("types"), F.count(F.lit(1)).alias("n"))
    own = everything.filter("not inlined").select("element", F.col("element").alias("own"))
    further = texts.select("key", "n", F.explode("types").alias("element")).join(own, "element", "left")
    further = materialize(further.groupBy("key").agg(F.first("n").alias("n"), F.collect_list("own").alias("own")), "further")
    return lookup(marked.drop("types"), further, ["key"], "n", ["capture_id"]).select("capture_id", "source_meta", "own")


def shred(raw: DataFrame, holders: dict[str, str], wanted: dict[str, list[str] | None] | None = None, columns: tuple[str, ...] = KEYS) -> DataFrame:
    """Rows of all tables of a layout, told apart by ``table_name``: ``columns`` of KEYS, and ``fields``.
    (capture_id, row_id) is the key of a row and (capture_id, parent_id) that of the row it stands
    in; ``wanted`` restricts the tables and, by table, the fields (None: all). Captures with a null
    id keep a null key. Unreadable meta gives no row; equal rows of one task come once."""
    metas = raw.select("capture_id", "source_meta").filter(F.col("source_meta").isNotNull())
    common, everything = dict(holders), getattr(holders, "everything", None)
    if everything is None:
        return _rows(metas, common, wanted, columns)
    if wanted is not None and None not in wanted.values() and not {"parent_table", "parent_id"} & set(columns):
        # only the wanted tables, and the types that a path of a field goes through, decide here
        for kind in [k for w, names in wanted.items() for n in names for k in _through(w, n)] + list(wanted):
            if (holder := holders.get(kind)) is not None:
                common[kind] = holder
        return _rows(metas, common, wanted, columns)
    further = _with_further(metas, common, everything)
    return _rows(metas, common, wanted, columns, strict=True).unionByName(_rows(further, common, wanted, columns))


def _through(kind: str, path: str) -> Iterator[str]:
    """The types that :func:`pick` goes through."""
    for field in path.split(".")[:-1]:
        kind = child_type(kind, field, True, 0)
        yield kind


def table(shredded: DataFrame, name: str, names: list[str]) -> DataFrame:
    """One of the tables, its rows distinct, with ``names`` of its fields as columns (dots as ``_``)."""
    keys = [c for c in shredded.columns if c not in ("table_name", "fields")]
    values = [F.coalesce(F.col("fields")[n], F.lit("")).alias(n.replace(".", "_")) for n in names]
    return shredded.filter(F.col("table_name") == name).select(*keys, *values).distinct()
