import json
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import shred
from tests.test_drift_and_shred import GRAPH, raw

NAMES = ["a", "b", "c", "d.e", "", "7", "nodes", "properties"]


def anything(draw, depth):
    """A random value: objects and lists under few names, graphs in places, some of it as text."""
    kind = draw.random()
    if depth == 0 or kind < 0.2:
        return draw.choice([1, "x", None, "{", 2.5])
    if kind < 0.3:
        return json.dumps(anything(draw, depth - 1))
    if kind < 0.45:
        return [anything(draw, depth - 1) for _ in range(draw.randint(0, 2))]
    if kind < 0.52:
        return {"nodes": [{"id": 1, "type": "A", "properties": anything(draw, depth - 1)}], "definitions": {"subgraphs": [{"id": "s", "nodes": [{"id": 2}]}]}}
    if kind < 0.58:
        return {"5": {"class_type": "K", "inputs": anything(draw, depth - 1)}}
    return {draw.choice(NAMES): anything(draw, depth - 1) for _ in range(draw.randint(1, 3))}


def content(rows):
    return {(*(r[c] for c in rows.columns if c != "fields"), tuple(sorted(r["fields"].items()))) for r in rows.collect()}


def described(df):
    return sorted(map(tuple, shred.describe(df).collect()))


def random_records(seed, count, depth):
    draw = random.Random(seed)
    return [("2026-01", f"c{n % 7}" if n % 5 else None, {draw.choice(NAMES[:4]): anything(draw, depth) for _ in range(2)}) for n in range(count)]


RECORDS = [
    [("2026-01", "c1", {"g": GRAPH})],
    [("2026-01", "c1", {"g": {"h": {"nodes": 5, "x": {"class_type": "K", "inputs": {"o": {"p": 1}}}}}})],
    [("2026-01", "c1", {"a": {"b": {"c": {"a": {"v": 1}}, "e": {"f": 2}}}, "k": {"l": {"m": [{"n": {"o": 1}}]}}})] * 3,
    *(random_records(seed, 4 * seed, 5) for seed in (2, 4)),
]


@pytest.mark.parametrize("records", RECORDS, ids=range(len(RECORDS)))
def test_the_layout_by_joins_is_the_layout(spark, monkeypatch, records):
    df = raw(spark, *records)
    holders, table = shred.measured_layout(df), described(df)
    rows = content(shred.shred(df, holders))
    links = ("table_name", "capture_id", "row_id", "entry_key", "graph")
    few = {"node": ["id", "properties.cnr_id"], "api_node": ["class_type"], "capture.a": ["b.c.v"]}
    narrow = content(shred.shred(df, holders, few, links))
    assert holders.everything is None and rows
    monkeypatch.setattr(shred, "LAYOUT_EDGES", 4)
    assert described(df) == table
    beyond = shred.measured_layout(df)
    assert len(beyond) == 4 and all(beyond.get(t) == holders[t] for t in list(holders)[:9]) and beyond.get("none") is None
    assert content(shred.shred(df, beyond)) == rows
    assert content(shred.shred(df, beyond, few, links)) == narrow


def test_every_type_counts_whatever_their_number(spark):
    many = {f"f{n}": {"v": n} for n in range(shred.LAYOUT_EDGES + 100)}
    late = {"zz": [{"v": 1, "in": {"w": 2}}, {"v": 3}], "zy": {"zy": {"v": 4}}}
    df = raw(spark, ("2026-01", "c1", many), ("2026-01", "c2", many | late), ("2026-01", "c3", late), ("2026-01", "c4", {"f1": {"v": 1}}))
    holders = shred.measured_layout(df)
    assert len(holders) == shred.LAYOUT_EDGES and holders["capture.zz[]"] == "capture.zz[]" and holders["capture.zz[].in"] == "capture.zz[]"
    rows = shred.shred(df, holders)
    found = {(r["table_name"], r["n"]) for r in rows.groupBy("table_name").agg(F.count("*").alias("n")).collect()}
    assert found == {("capture", 4), ("capture.zz[]", 4), ("capture.zy", 4)}
    assert {(r["capture_id"], r["v"], r["in_w"]) for r in shred.table(rows, "capture.zz[]", ["v", "in.w"]).collect()} == {
        (c, v, w) for c in ("c2", "c3") for v, w in (("1", "2"), ("3", ""))
    }
    assert shred.describe(df).count() == len(many) + 4


def test_nodes_are_found_beyond_any_number_of_types(spark, tmp_path, monkeypatch):
    from graphloom.plans import problems

    odd = {"nodes": [{"id": 1, "type": "A", "properties": {"cnr_id": "p", "properties": {"cnr_id": "q"}}}, {"id": 2, "type": "B"}]}
    raw(spark, ("2026-01", "c1", odd), ("2026-01", "c2", {"g": GRAPH, "p": {"5": {"class_type": "K"}}})).write.parquet(f"{tmp_path}/raw_artifacts.parquet")
    want = {name: sorted(map(tuple, problems.QUERIES[name](spark, str(tmp_path)).collect())) for name in ("p3_found", "p3_subgraphs", "p3_layout", "p3_tables")}
    assert len(want["p3_found"]) == 7
    monkeypatch.setattr(shred, "LAYOUT_EDGES", 2)
    for name, rows in want.items():
        assert sorted(map(tuple, problems.QUERIES[name](spark, str(tmp_path)).collect())) == rows
