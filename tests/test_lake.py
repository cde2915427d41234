import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from graphloom.functions.graph import derive
from graphloom.operators import attribution
from graphloom.plans.ingest import Lake
from graphloom.schemas import TABLES
from graphloom.sources.manifests import blob_rows, drop_blobs, list_manifests, read_blobs, write_blobs, write_manifest
from graphloom.streaming.ingest import run_available
from tests.test_graph_documents import CANVAS, PROMPT

SHA = {name: f"{n:x}" * 64 for n, name in enumerate(("canvas", "prompt", "bad", "missing"), 10)}


def record(n, sha, kind="workflow", **more):
    return {
        "capture_id": f"s:{n}:api:{kind}", "crawled_at": "2026-03-01T00:00:00+00:00", "source": "s", "channel": "api", "source_artifact_id": str(n),
        "payload_kind": kind, "payload_sha256": sha, "source_meta": {"id": n, "x": 8.0},
    } | more


def write(root, key, records):
    path = f"{root}/{key}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("".join(json.dumps(r) + "\n" for r in records) + "\n")


def blob(root, sha, document):
    path = f"{root}/blob/{sha[:2]}/{sha}.json.gz"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(document)


@pytest.fixture
def bucket(tmp_path):
    root = str(tmp_path / "bucket")
    blob(root, SHA["canvas"], json.dumps(CANVAS))
    blob(root, SHA["prompt"], json.dumps(PROMPT))
    blob(root, SHA["bad"], json.dumps({"nodes": [{"id": [1]}]}))
    write(root, "raw/s/2026-03/ff-0001.jsonl.gz", [
        record(1, SHA["canvas"]), record(2, SHA["canvas"], published_at="2026-02-01T00:00:00Z"), record(3, SHA["bad"]), record(4, SHA["missing"]), record(5, None, "none"),
    ])
    return root


@pytest.fixture
def lake(spark, tmp_path):
    core = spark.createDataFrame([("Opener", False), ("Mixer", True), (None, None), ("CheckpointLoaderSimple", False), ("KSampler", True)], "class_type string, hidden_prompt boolean")
    nodes = spark.createDataFrame([("Loader", "pack-a", "", "", "", "m"), ("Loader", "pack-b", "", "", "", "m"), ("Sampler", "", "https://h.example/O/R.git", "", "", "m")], TABLES["pack_nodes"].schema)
    packs = spark.createDataFrame([("pack-r", "pack-r", "h.example/o/r", "")], "pack_id string, cnr_id string, repo string, repo_url string")
    return Lake(spark, str(tmp_path / "lake"), core, nodes, packs)


def test_ingest_end_to_end(spark, lake, bucket):
    first = lake.ingest(bucket)
    assert (first["manifests"], first["records"], first["skipped"]) == (1, 5, 2)
    assert first["rows"]["derived_workflows"] == 1 and first["rows"]["derived_artifact_workflows"] == 2
    flow = lake.table("derived_workflows").head()
    want = derive(CANVAS)
    assert flow["workflow_id"] == want["workflow_id"] and flow["pack_set"] == ["tool-pack"] and str(flow["first_seen"])[:10] == "2026-03-01"
    assert (flow["stamped_nodes"], flow["cnr_nodes"], flow["aux_nodes"], flow["muted_or_bypassed"], flow["hidden_prompt_nodes"]) == (2, 2, 1, 1, 1)
    raw = {r["source_artifact_id"]: r for r in lake.table("raw_artifacts").collect()}
    assert [raw[str(n)]["workflow_id"] != "" for n in range(1, 6)] == [True, True, False, False, False]
    assert raw["1"]["source_meta"] == '{"id": 1, "x": 8.0}' and raw["5"]["payload_kind"] == "none"
    assert lake.ingest(bucket)["manifests"] == 0

    # a name that sorts lower is new all the same
    write(bucket, "raw/s/2026-03/aa-0000.jsonl.gz", [record(6, SHA["prompt"], "prompt")])
    again = lake.ingest(bucket, limit=1)
    assert (again["manifests"], again["remaining"], again["rows"]["derived_workflow_nodes"]) == (1, 0, 2)
    found = {r["class_type"]: r for r in lake.table("derived_workflow_nodes").filter("class_type IN ('Loader', 'Sampler')").collect()}
    assert (found["Loader"]["packs"], found["Loader"]["pack_ambiguous"]) == (["pack-a", "pack-b"], True)
    assert (found["Sampler"]["packs"], found["Sampler"]["pack_unknown"]) == (["pack-r"], False)
    assert lake.table("derived_workflow_bindings").count() == 3

    # reading everything again adds physical rows, no logical ones
    logical = {name: lake.table(name).count() for name in lake_tables()}
    lake.reset()
    lake.ingest(bucket)
    assert {name: lake.table(name).count() for name in lake_tables()} == logical
    assert lake.compact("derived_workflow_nodes") == 6 and lake.physical("derived_workflow_nodes").count() == 6
    assert lake.by_class().count() == 6 and lake.check() == {}


def lake_tables():
    return ["raw_artifacts", "derived_workflows", "derived_workflow_nodes", "derived_workflow_bindings", "derived_artifact_workflows"]


def test_stream_takes_late_files(spark, lake, bucket, tmp_path):
    documents = spark.createDataFrame([(SHA["canvas"], json.dumps(CANVAS))], "sha256 string, document string")
    check = str(tmp_path / "checkpoint")
    assert sum(r["records"] for r in run_available(lake, bucket, documents, check)) == 5
    assert run_available(lake, bucket, documents, check) == []
    write(bucket, "raw/s/2026-01/00-0000.jsonl.gz", [record(9, None, "none")])
    old = 1_500_000_000
    os.utime(f"{bucket}/raw/s/2026-01/00-0000.jsonl.gz", (old, old))
    assert sum(r["records"] for r in run_available(lake, bucket, documents, check)) == 1


def test_empty_bucket_and_writers(spark, lake, tmp_path):
    assert list_manifests(spark, str(tmp_path / "none")).count() == 0
    assert lake.ingest(str(tmp_path / "none"))["manifests"] == 0
    df = spark.range(60).select(F.col("id").cast("string").alias("capture_id"))
    write_manifest(df.coalesce(1), str(tmp_path / "out"), 25)
    assert len([f for f in os.listdir(tmp_path / "out") if f.endswith(".json.gz")]) == 3


def test_blobs_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "store")
    payloads = spark.createDataFrame([(b"a", "workflow"), (b"a", "prompt"), (b"a", "prefix"), (b"b", "workflow"), (None, "workflow")], "content binary, kind string")
    none = spark.createDataFrame([], "sha256 string, kind_class string")
    for _ in range(2):
        written = write_blobs(payloads, root)
        stored = blob_rows(written, none, 30, F.timestamp_seconds(F.lit(0)))
        assert stored.count() == 3 and stored.filter("expires_at IS NOT NULL").count() == 1
    files = [f for _, _, fs in os.walk(root) for f in fs]
    assert len(files) == 3 and sorted(f.split(".", 1)[1] for f in files) == ["bin.gz", "json.gz", "json.gz"]
    assert blob_rows(written, stored.select("sha256", "kind_class")).count() == 0
    assert drop_blobs(stored.filter("kind = 'prefix'"), root) == 1 and drop_blobs(stored.filter("kind = 'prefix'"), root) == 1


def test_only_the_blobs_wanted_are_read(spark, bucket):
    blob(bucket, "ab" + "0" * 62, "not read, so that it is not JSON does not matter")
    wanted = spark.createDataFrame([(SHA["canvas"],), (SHA["missing"],), (None,)], "sha256 string")
    got = {r["sha256"]: r["document"] for r in read_blobs(wanted, bucket).collect()}
    assert got == {SHA["canvas"]: json.dumps(CANVAS), SHA["missing"]: None}


def test_every_failure_is_counted(spark, lake, tmp_path):
    root = str(tmp_path / "many")
    write(root, "raw/s/2026-03/a.jsonl.gz", [record(n, f"{n:064x}") for n in range(150)])
    write(root, "raw/s/2026-03/b.jsonl.gz", [record(n, f"{n:064x}") for n in range(150, 160)])
    got = lake.ingest(root, per_load=1)
    assert (got["manifests"], got["skipped"], got["remaining"], len(got["skipped_examples"])) == (2, 160, 0, 10)


def test_many_reasons(spark, lake, monkeypatch):
    from graphloom.plans import ingest

    rows = [(str(n), f"{n:064x}", f"Reason{n}: x") for n in range(150)]
    monkeypatch.setattr(ingest, "failures", lambda *_: spark.createDataFrame(rows, "source_artifact_id string, payload_sha256 string, error string"))
    lines = spark.createDataFrame([], ingest.store.MANIFEST).withColumns({"manifest_key": F.lit("m"), "line": F.lit(1).cast("long")})
    got = lake.load(lines, spark.createDataFrame([], "sha256 string, document string"))
    assert got["skipped"] == 150 and len(got["skipped_reasons"]) == 100


def test_repair_brings_tables_to_their_schema(spark, lake, bucket):
    lake.ingest(bucket)
    at = lake._at("derived_workflows")
    odd = spark.read.parquet(at).drop("pack_set_size").withColumns({"node_count": F.col("node_count").cast("string"), "extra": F.lit(1)})
    rows = odd.collect()
    spark.createDataFrame(rows, odd.schema).write.mode("overwrite").parquet(at)
    assert len(lake.check()["derived_workflows"]) == 3
    lake.repair()
    assert lake.check() == {} and lake.table("derived_workflows").head()["pack_set_size"] is None
    assert lake.ingest(bucket)["manifests"] == 1 and lake.table("derived_workflows").head()["node_count"] > 0


def test_attribution_keeps_rows_and_handles_nulls(spark, lake):
    rows = [("CheckpointLoaderSimple", None), ("CheckpointLoaderSimple", "comfy-core"), ("KSampler", "https://h.example/o/r"), ("Nowhere", ""), (None, None), ("Note", "")]
    nodes = spark.createDataFrame(rows, "class_type string, cnr_id string").withColumns({"packs": F.lit("old"), "n": F.lit(1), "rank": F.lit(2)})
    got = attribution.attribute(nodes, lake.core, lake.named, lake.repos, ["n"]).collect()
    by = {(r["class_type"], r["cnr_id"]): (r["is_core"], r["packs"], r["pack_unknown"]) for r in got}
    assert len(got) == 6 and by["KSampler", "https://h.example/o/r"] == (True, ["pack-r"], False)
    assert by["Nowhere", ""] == (False, [], True) and by[None, None] == (False, [], True) and by["Note", ""] == (True, [], False)
