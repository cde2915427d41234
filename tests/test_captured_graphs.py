import json

from graphloom.functions.graph import derive
from graphloom.plans import jobs
from graphloom.plans.ingest import Lake
from graphloom.schemas import MANIFEST, TABLES
from tests.test_graph_documents import CANVAS, PROMPT

LINE = MANIFEST + ", manifest_key string, line bigint"


def lines(spark, *rows):
    names = [c.split()[0] for c in LINE.split(", ")]
    base = dict.fromkeys(names) | {"crawled_at": "2026-03-01T00:00:00Z", "source": "s", "channel": "api", "manifest_key": "raw/s/2026-03/a.jsonl.gz"}
    made = [base | {"capture_id": f"c{n}", "source_artifact_id": str(n), "line": n, "payload_kind": kind, "payload_sha256": sha, "source_meta": meta} for n, (kind, sha, meta) in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in made], LINE)


def test_every_graph_of_every_capture_is_loaded(spark, tmp_path):
    small = {"nodes": [{"id": 1, "type": "Only"}], "links": []}
    rows = [
        ("workflow", "aa", json.dumps({"x": CANVAS})), ("workflow", "sha256:AA", "zzz, the greatest meta, not readable"), ("prompt", "bb", json.dumps({"p": PROMPT, "w": small})),
        ("workflow", "bb", json.dumps({"z": "no graph"})), ("workflow", "cc", "{}"), ("none", None, json.dumps({"w": {"nodes": [{"id": 7, "type": "Unwanted"}]}})),
    ]
    got = jobs.carry_graphs(lines(spark, *rows))
    carried = {r["capture_id"]: r["documents"] for r in got.collect()}
    assert [len(carried[f"c{n}"]) for n in range(6)] == [1, 1, 2, 1, 0, 0] and carried["c1"] == carried["c0"]
    empty = {name: spark.createDataFrame([], TABLES[name].schema) for name in ("pack_nodes", "packs")}
    lake = Lake(spark, str(tmp_path / "lake"), spark.createDataFrame([], "class_type string, hidden_prompt boolean"), empty["pack_nodes"], empty["packs"])
    result = lake.load(got, jobs.captured_documents(got))
    want = {derive(g)["workflow_id"] for g in (CANVAS, PROMPT, small)}
    assert {r["workflow_id"] for r in lake.table("derived_workflows").collect()} == want
    raw = {r["capture_id"]: (r["payload_ref"], r["workflow_id"] != "") for r in lake.table("raw_artifacts").collect()}
    assert raw == {"c0": ("aa", True), "c1": ("sha256:AA", True), "c2": ("bb", True), "c3": ("bb", True), "c4": ("cc", False), "c5": ("", False)}
    assert (result["records"], result["skipped"]) == (6, 1)
