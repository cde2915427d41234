import json

from pyspark.sql import functions as F

from graphloom.operators import drift, shred

RAW = "source string, manifest_key string, capture_id string, workflow_id string, source_meta string"


def raw(spark, *rows):
    return spark.createDataFrame([("s", f"raw/s/{m}/x.jsonl.gz", c, "", meta if meta is None or isinstance(meta, str) else json.dumps(meta)) for m, c, meta in rows], RAW)


def changes(spark, *rows):
    flat = drift.flatten(raw(spark, *rows))
    return {(r["step"], r["old_field"], r["new_field"], r["drift"]) for r in drift.changes(flat).collect()}


def test_changes_of_all_kinds(spark):
    got = changes(
        spark,
        ("2026-01", "c1", {"a": 1, "b": {"c": "x"}, "gone": True, "n": None, "l": [1]}),
        ("2026-01", "c2", {"a": 2, "old": "q"}),
        ("2026-02", "c1", {"a": "1", "b": {"c": "x"}, "list": [1]}),
        ("2026-02", "c2", {"a": 3, "new": "q"}),
    )
    assert got == {
        ("2026-02", "a", "a", "retyped"), ("2026-02", "gone", "", "removed"), ("2026-02", "l", "", "removed"), ("2026-02", "", "list", "added"),
        ("2026-02", "old", "new", "renamed"),
    }


def test_one_disagreeing_pair_is_no_rename(spark):
    got = changes(spark, ("2026-01", "c1", {"o": 1}), ("2026-01", "c2", {"o": 1}), ("2026-02", "c1", {"n": 1.0}), ("2026-02", "c2", {"n": 2}))
    assert got == {("2026-02", "o", "", "removed"), ("2026-02", "", "n", "added")}
    assert ("2026-02", "o", "n", "renamed") in changes(spark, ("2026-01", "c1", {"o": 1}), ("2026-02", "c1", {"n": 1.0}))


def test_unreadable_meta_is_skipped(spark):
    bad = [("2026-01", "c", x) for x in (None, "", "null", "{", "[1]", '"x"', "7")]
    twice = json.dumps(json.dumps({"a": "\ud800" + "x" * 500_000}))
    flat = drift.flatten(raw(spark, *bad, ("2026-01", None, twice), ("none", "c", {"a": 1})))
    assert [len(r["fields"]) for r in flat.collect()] == [1]
    assert drift.changes(flat.limit(0)).count() == 0


def test_versions_and_unified_table(spark):
    df = raw(
        spark, ("2026-01", "c1", {"w": 5, "k": 1}), ("2026-02", "c1", {"width": 5, "k": 1}), ("2026-03", "c1", {"size": {"w": "5"}, "k": 1}), ("2026-03", "c2", {"k": 2}),
        ("2026-02", "c3", {"width": 7}), ("2026-03", "c3", {"size": {"w": "7"}, "k": 2}),
    ).withColumn("month", F.lit("clash"))
    flat = drift.flatten(df)
    types = drift.field_types(flat)
    assert [r["version"] for r in drift.versions(types).orderBy("month").collect()] == [1, 2, 3]
    plan = drift.MigrationPlan(drift.changes(flat), types)
    got = {(r["month"], r["capture_id"]): (r["fields"], r["renamed"], r["defaulted"]) for r in drift.unify(df, plan, {"size.w": "0"}).collect()}
    assert got["2026-01", "c1"][0]["width"] == "5" and got["2026-01", "c1"][1] == 1  # 5 and "5" are not equal: no further rename
    assert got["2026-03", "c2"] == ({"k": "2", "size.w": "0"}, 0, 1)


def test_casts():
    assert drift.cast_text("12", "number") == ("12", True)
    assert drift.cast_text("x", "number") == ("x", False)
    assert drift.cast_text(True, "string") == ("true", True)
    assert drift.cast_text("True", "boolean") == ("true", True)


def test_reshaped_notation(spark):
    df = spark.createDataFrame([(1, "1.2"), (1, None), (2, "1.10"), (2, " "), (3, "v1.2"), (None, "x")], "b int, v string")
    got = [(r["step"], r["old_field"], r["drift"]) for r in drift.reshaped(df, "t", "b", ["v"]).collect()]
    assert got == [("03", "v", "reshaped")]


GRAPH = {
    "nodes": [{"id": 1, "type": "A", "properties": {"cnr_id": "p"}}, {"id": "2:0", "type": "B", "properties": None}, "junk"],
    "definitions": {"subgraphs": [{"id": "s1", "nodes": [{"id": 3, "type": "C"}], "definitions": {"subgraphs": [{"id": "s2", "nodes": [{"type": "D", "id": None}]}]}}]},
}


EVERYTHING = {t: t for t in ("capture", "save_graph", "api_graph", "definitions", "subgraph", "node", "api_node")}


def nodes(meta):
    wanted = {"node": ["id", "type", "properties.cnr_id"], "api_node": ["class_type"]}
    out = []
    for table, _, _, _, key, graph, _, parent, own, fields in shred.record_rows(json.dumps(meta), EVERYTHING, wanted):
        f = dict(fields)
        out.append((graph, parent, own, key, f["class_type"], "") if table == "api_node" else (graph, parent, own, f["id"], f["type"], f["properties.cnr_id"]))
    return out


def test_nodes_of_nested_subgraphs():
    assert set(nodes({"x": [{"deep": GRAPH}]})) == {
        ("workflow", "", "", "1", "A", "p"), ("workflow", "", "", "2:0", "B", ""), ("workflow", "", "s1", "3", "C", ""), ("workflow", "s1", "s2", "", "D", ""),
    }


def test_prompt_graphs_and_texts():
    prompt = {"5": {"class_type": "K", "inputs": {}}, "6": {"inputs": {}}, "7": 1}
    assert {(n[0], n[3], n[4]) for n in nodes({"p": prompt})} == {("prompt", "5", "K"), ("prompt", "6", "")}
    assert len(nodes({"t": json.dumps(json.dumps({"around": GRAPH}))})) == 4
    assert nodes({"nodes": "3", "5": {"class_type": "K"}}) == []
    assert list(shred.record_rows(None, EVERYTHING)) == [] and list(shred.record_rows("{", EVERYTHING)) == []


def test_graph_in_a_subgraph_text():
    inner = {"nodes": [{"id": 9, "type": "Z"}]}
    outer = {"nodes": [], "definitions": {"subgraphs": [{"id": "s", "nodes": [{"id": 1, "type": "A", "note": json.dumps(inner)}]}]}}
    assert sorted((n[2], n[3]) for n in nodes(outer)) == [("", "9"), ("s", "1")]


def test_a_node_that_is_a_graph_too():
    both = {"nodes": [{"id": 1, "type": "A", "nodes": [{"id": 2, "type": "B"}]}]}
    assert sorted((n[0], n[3], n[4]) for n in nodes(both)) == [("workflow", "1", "A"), ("workflow", "2", "B")]


def test_no_limit_of_depth_or_encodings(spark):
    text = json.dumps(GRAPH)
    for _ in range(6):
        text = json.dumps(text)
    assert len(nodes({"t": text})) == 4
    for depth in (2_000, 30_000):
        text = '{"a":' * depth + json.dumps(GRAPH) + "}" * depth
        df = raw(spark, ("2026-01", "c", text))
        holders = shred.measured_layout(df)
        assert shred.shred(df, holders, {"node": ["id"]}).count() == 4
    deep = "[" * 100_000 + "]" * 100_000
    assert [r[0] for r in shred.record_rows('{"a":' + deep + "}", EVERYTHING)] == ["capture"]


def test_layout():
    edges = [("r", "t", True), ("t", "one", False), ("one", "two", False), ("t", "shared", False), ("r", "shared", False), ("t", "rec", False), ("rec", "rec", False)]
    assert shred.layout(edges) == {"one": "t", "r": "r", "rec": "rec", "shared": "shared", "t": "t", "two": "t"}


def test_tables_are_linked(spark):
    df = raw(spark, ("2026-01", "c1", {"g": GRAPH}), ("2026-01", None, {"g": GRAPH})).withColumn("table_name", F.lit("clash"))
    holders = shred.measured_layout(df)
    rows = shred.shred(df, holders)
    found = {r["table_name"]: r["n"] for r in rows.groupBy("table_name").agg(F.count("*").alias("n")).collect()}
    assert found == {"capture": 2, "definitions": 4, "subgraph": 4, "node": 8}
    keys = rows.select(F.col("capture_id").alias("c"), F.col("row_id").alias("r"), F.col("table_name").alias("t"))
    linked = rows.filter("parent_table <> ''").join(keys, F.col("capture_id").eqNullSafe(F.col("c")) & (F.col("parent_id") == F.col("r")) & (F.col("parent_table") == F.col("t")))
    assert linked.count() == rows.count() - 2
    assert shred.schema_graph(df).filter("child = 'subgraph'").head()["occurrences"] == 4
    held = {r["element"]: r["table_name"] for r in shred.describe(df).collect()}
    assert held["node.properties"] == "node" and held["definitions"] == "definitions" and held["save_graph"] == "capture"
    assert {r["properties_cnr_id"] for r in shred.table(rows, "node", ["id", "properties.cnr_id"]).collect()} == {"p", ""}


def test_an_element_never_seen_gets_its_table(spark):
    df = raw(
        spark, ("2026-01", "c1", {"shop": {"name": "n", "offers": [{"price": 3, "seller": {"id": 7}}, {"price": 4, "tags": ["x", None]}]}}),
        ("2026-01", "c2", {"shop": {"name": "m"}, "12": {"v": 1}, "13": {"v": 2}}), ("2026-01", "c3", {"t": {"t": {"t": {"v": 1}}}}),
    )
    holders = shred.measured_layout(df)
    assert holders["capture.shop"] == "capture" and holders["capture.shop.offers[]"] == "capture.shop.offers[]"
    rows = shred.shred(df, holders)
    offers = {(r["price"], r["seller_id"], r["tags"]) for r in shred.table(rows, "capture.shop.offers[]", ["price", "seller.id", "tags"]).collect()}
    assert offers == {("3", "7", ""), ("4", "", '["x", null]')}
    assert {r["shop_name"] for r in shred.table(rows, "capture", ["shop.name"]).collect()} == {"n", "m", ""}
    assert sorted(r["entry_key"] for r in rows.filter("table_name = 'capture.*'").collect()) == ["12", "13"]
    assert rows.filter("table_name = 'capture.t'").count() == 3 and holders["capture.t"] == "capture.t"


def test_a_type_outside_the_layout_is_inlined():
    rows = list(shred.record_rows(json.dumps({"a": {"b": [{"c": 1}, {"c": 2}], "d.e": 3, "d": {"e": 4}}}), {"capture": "capture"}))
    assert [r[0] for r in rows] == ["capture"]
    assert sorted(dict(rows[0][-1]).values()) == ["1", "2", "3", "4"]


def test_stamps_with_a_table_of_their_own(spark, tmp_path):
    from graphloom.plans import problems

    odd = {"nodes": [{"id": 1, "type": "A", "properties": {"cnr_id": "p", "properties": {"cnr_id": "q"}}}, {"id": 2, "type": "B"}]}
    raw(spark, ("2026-01", "c1", odd)).write.parquet(f"{tmp_path}/raw_artifacts.parquet")
    got = {(r["node_id"], r["cnr_id"]) for r in problems.p3_found(spark, str(tmp_path)).collect()}
    assert got == {("1", "p"), ("2", "")}


def test_colliding_names_are_both_kept(spark):
    df = raw(spark, ("2026-01", "c1", {"old": 5}), ("2026-02", "c1", {"new": 5}), ("2026-01", "c2", {"old": 5, "new": 6}), ("2026-01", "c3", {"old": 6, "new": 6}))
    types = drift.field_types(drift.flatten(df))
    plan = drift.MigrationPlan(df.limit(0).selectExpr("'' source", "'' step", "'' old_field", "'' new_field", "'' drift"), types)
    plan.renames = {"s": [("2026-02", "old", "new")]}
    got = {(r["capture_id"], r["month"]): (r["fields"], r["conflicts"], r["renamed"]) for r in drift.unify(df, plan).collect()}
    assert got["c2", "2026-01"] == ({"new": "6", "old": "5"}, 1, 0)
    assert got["c3", "2026-01"] == ({"new": "6"}, 0, 1) and got["c1", "2026-01"] == ({"new": "5"}, 0, 1)
