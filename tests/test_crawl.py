import datetime as dt
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom import cli
from graphloom.plans import crawl, samples
from graphloom.sources.pages import AuthRequired, RecordedPages, lookup_records, refuse, write_pages
from graphloom.sources.store import StateStore
from tests.test_graph_documents import CANVAS

NOW = dt.datetime(2026, 5, 1)


def item(n, post=None, user=1, tools=(86,), **more):
    return {"id": n, "postId": post, "userId": user, "url": f"f{n}", "toolIds": list(tools), "hasMeta": True, "publishedAt": ["Date", f"2026-04-{n % 28 + 1:02d}T00:00:00Z"]} | more


@pytest.fixture
def pages(spark, tmp_path):
    root = str(tmp_path / "pages")
    tip = [[item(9, 1), item(8, 1), item(7)], [item(7), item(6, 2, user=2)], [item(9, 1)], [item(8, 1)], [item(5)]]
    write_pages(root, "tip", tip)
    write_pages(root, "user-1", [[item(4)], [item(3, tools=())], [item(2)]])
    spark.dataSource.register(RecordedPages)
    return root, spark.read.format("recorded_pages").option("path", root).load()


def test_tip_stops_after_two_dry_pages(spark, pages, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    got = crawl.discover_tip(store, pages[1], "s", NOW)
    # 8 is a second image of post 1; pages 2 and 3 bring nothing, so page 4 is not read
    assert (got["pages"], got["queued"], got["caught_up"], got["frontier_id"], got["new_partitions"]) == (4, 3, True, "9", 2)
    assert {r["artifact_id"] for r in store.read("queue").collect()} == {"9", "7", "6"}
    again = crawl.discover_tip(store, pages[1], "s", NOW)
    assert (again["pages"], again["queued"], again["new_partitions"]) == (2, 0, 0)
    assert store.read("queue").count() == 3 and crawl.status(store, "s")["tip_cursor"] == "9"


def test_backlog_resumes_and_drains(spark, pages, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    crawl.discover_tip(store, pages[1], "s", NOW, max_pages=1)
    first = crawl.discover_backlog(store, pages[1], "s", NOW, partitions=1, max_pages=2)
    assert first == {"drained": 1, "exhausted": 0, "queued": 1}
    second = crawl.discover_backlog(store, pages[1], "s", NOW + dt.timedelta(days=1), partitions=1, max_pages=2)
    assert second == {"drained": 1, "exhausted": 1, "queued": 1}
    assert crawl.status(store, "s")["partitions"] == {"user_exhausted": 1, "user_pending": 0}


def test_fetch_stores_before_it_marks(spark, pages, tmp_path):
    store, out = StateStore(spark, str(tmp_path / "state")), str(tmp_path / "bucket")
    crawl.discover_tip(store, pages[1], "s", NOW)
    document = json.dumps(CANVAS)
    files = spark.createDataFrame([("9", bytearray(samples.png_file({"workflow": document}))), ("7", bytearray(b"GIF89a"))], "artifact_id string, content binary")
    got = crawl.fetch(store, files, "s", out, NOW)
    assert (got["claimed"], got["captured"], got["gone"], got["with_payload"], got["released"]) == (3, 2, 1, 1, 0)
    lines = {r["source_artifact_id"]: r for r in spark.read.json(f"{out}/raw/s/2026-05").collect()}
    assert lines["9"]["payload_kind"] == "workflow" and lines["7"]["payload_kind"] == "none"
    kinds = sorted(r["kind"] for r in store.read("blobs").collect())
    assert kinds == ["prefix", "prefix", "workflow"]
    assert crawl.status(store, "s")["queue"] == {"done": 2, "skipped": 1}
    assert crawl.fetch(store, files, "s", out, NOW)["claimed"] == 0
    objects = lambda: sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{out}/blob") for f in fs)
    assert len(objects()) == 3
    assert crawl.collect_garbage(store, out, NOW)["prefixes_removed"] == 0
    assert crawl.collect_garbage(store, out, NOW + dt.timedelta(days=31), 1)["prefixes_removed"] == 1
    assert store.read("blobs").count() == 2 and len(objects()) == 2


def test_deadline_gives_leases_back(spark, pages, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    crawl.discover_tip(store, pages[1], "s", NOW)
    files = spark.createDataFrame([("9", bytearray(b"x"))], "artifact_id string, content binary")
    got = crawl.fetch(store, files, "s", str(tmp_path / "bucket"), NOW, deadline=NOW)
    assert got["captured"] == 0 and got["released"] == 1 and crawl.status(store, "s")["queue"] == {"pending": 1, "skipped": 2}


def requests(spark, store, *statuses):
    rows = [("files.example", NOW + dt.timedelta(seconds=n), s) for n, s in enumerate(statuses)]
    store.append("requests", spark.createDataFrame(rows, "host string, ts timestamp, status int"))


def test_gate_and_exit_codes(spark, pages, tmp_path, capsys):
    root = str(tmp_path)
    store = StateStore(spark, f"{root}/state")
    files = str(tmp_path / "files")
    spark.createDataFrame([("9", bytearray(b"x"))], "artifact_id string, content binary").write.parquet(files)
    run = lambda *a, later=0: cli.main(["--root", root, "--source", "s", "--now", str(NOW + dt.timedelta(seconds=later)), *a], spark)
    assert run("discover-tip", "--pages", pages[0]) == 0
    requests(spark, store, 503, 503, 503)
    assert run("fetch", "--files", files, later=60) == 0 and "backing_off" in capsys.readouterr().out
    requests(spark, store, 200, 403, 403, 403)
    assert run("fetch", "--files", files, later=9000) == 2 and "latched" in capsys.readouterr().err
    assert run("status") == 0 and json.loads(capsys.readouterr().out)["latched"][0]["host"] == "files.example"
    assert run("unlatch", "--host", "files.example", later=9001) == 0 and json.loads(capsys.readouterr().out)["cleared"] is True
    assert run("unlatch", "--host", "files.example", later=9002) == 0 and json.loads(capsys.readouterr().out)["cleared"] is False
    assert run("fetch", "--files", files, later=9003) == 0
    assert run("selftest") == 0 and run("gc") == 0
    assert run("fetch", "--files", f"{root}/none") == 1


def test_whole_way_from_pages_to_tables(spark, pages, tmp_path, capsys):
    root, small = str(tmp_path), "/root/testdata/sf0.001"
    files = str(tmp_path / "files")
    spark.createDataFrame([("9", bytearray(samples.webp_file({"workflow": json.dumps(CANVAS)})))], "artifact_id string, content binary").write.parquet(files)
    run = lambda *a: cli.main(["--root", root, "--source", "s", *a], spark)
    assert run("discover-tip", "--pages", pages[0]) == 0 and run("fetch", "--files", files) == 0
    capsys.readouterr()
    assert run("ingest", "--dimensions", small) == 0
    assert json.loads(capsys.readouterr().out)["rows"]["derived_workflows"] == 1
    assert run("ingest", "--dimensions", small) == 0 and json.loads(capsys.readouterr().out)["manifests"] == 0
    assert run("check-schema", "--dimensions", small) == 0 and json.loads(capsys.readouterr().out) == {"drift": {}}


FILES = "artifact_id string, content binary, status int"


def png(document=CANVAS):
    return bytearray(samples.png_file({"workflow": json.dumps(document)}))


def test_refusals_go_back_and_latch_the_host(spark, pages, tmp_path):
    store, out = StateStore(spark, str(tmp_path / "state")), str(tmp_path / "bucket")
    crawl.discover_tip(store, pages[1], "s", NOW)
    answers = spark.createDataFrame([("9", None, 403), ("7", None, 403), ("6", None, 403)], FILES)
    with pytest.raises(crawl.Latched):
        crawl.fetch(store, answers, "s", out, NOW)
    assert crawl.status(store, "s")["queue"] == {"pending": 3} and crawl.status(store, "s")["latched"][0]["host"] == "files.example"
    with pytest.raises(crawl.Latched):  # and stays so
        crawl.fetch(store, answers, "s", out, NOW + dt.timedelta(days=3))
    args = ["--root", str(tmp_path), "--source", "s", "--now", str(NOW + dt.timedelta(days=4))]
    answers.write.parquet(str(tmp_path / "answers"))
    assert cli.main([*args, "fetch", "--files", str(tmp_path / "answers")], spark) == 2


def test_outcomes_of_all_kinds(spark, pages, tmp_path):
    store, out = StateStore(spark, str(tmp_path / "state")), str(tmp_path / "bucket")
    crawl.discover_tip(store, pages[1], "s", NOW)
    got = crawl.fetch(store, spark.createDataFrame([("9", png(), 200), ("7", None, 503), ("6", None, 403)], FILES), "s", out, NOW)
    assert (got["captured"], got["failed"], got["refused"], got["released"], got["gone"]) == (1, 1, 1, 1, 0)
    assert crawl.status(store, "s")["queue"] == {"done": 1, "failed": 1, "pending": 1}
    assert sorted(r["status"] for r in store.read("requests").collect()) == [200, 403, 503]


def test_retries_and_pacing(spark):
    tries = [("a", 1, 503), ("a", 2, 429), ("a", 3, 200), ("a", 4, 500), ("b", 1, 403), ("b", 2, 200), ("c", 1, 500), ("c", 2, 500), ("c", 3, 502), ("c", 4, 200)]
    df = spark.createDataFrame(tries, "artifact_id string, attempt int, status int")
    assert {(r["artifact_id"], r["attempt"], r["refusals"]) for r in crawl.settled(df).collect()} == {("a", 3, 1), ("b", 1, 1), ("c", 3, 0)}
    rows = spark.createDataFrame([("h", 1, None), ("h", 2, 4.0), ("h", 3, None), ("g", 1, None)], "host string, n int, wait double")
    assert {(r["host"], r["n"]): r["starts_after"] for r in crawl.paced(rows, "host", ["n"], 0.5, F.col("wait")).collect()} == {
        ("h", 1): 0.0, ("h", 2): 0.5, ("h", 3): 4.5, ("g", 1): 0.0,
    }


def test_the_api_channel_is_asked_for_what_the_bytes_lack(spark, pages, tmp_path):
    store, out = StateStore(spark, str(tmp_path / "state")), str(tmp_path / "bucket")
    crawl.discover_tip(store, pages[1], "s", NOW)
    answers = spark.createDataFrame([("9", png(), 200), ("7", bytearray(b"GIF89a"), 200), ("6", bytearray(b"GIF89a"), 200)], FILES)
    body = json.dumps({"result": {"data": {"json": {"meta": {"comfy": json.dumps({"workflow": CANVAS, "prompt": None})}}}}})
    api = spark.createDataFrame([("7", 200, body), ("6", 200, "not JSON"), ("9", 403, None)], "artifact_id string, status int, body string")
    got = crawl.fetch(store, answers, "s", out, NOW, api=api)
    assert (got["captured"], got["with_payload"], got["from_api"]) == (3, 2, 1)
    lines = {(r["source_artifact_id"], r["channel"], r["payload_kind"]) for r in spark.read.json(f"{out}/raw/s/2026-05").collect()}
    assert lines == {("9", "bytes_head", "workflow"), ("7", "api", "workflow"), ("6", "bytes_head", "none")}
    # the one whose bytes had a graph was not asked about
    assert {(r["host"], r["status"]) for r in store.read("requests").collect()} == {("files.example", 200), ("api.example", 200)}


def test_lookups_of_records(spark):
    body = json.dumps({"result": {"data": {"json": {"id": 5, "url": "x"}}}})
    answers = spark.createDataFrame([("5", 200, body), ("6", 500, body), ("7", 200, "{"), ("8", 200, json.dumps({"result": {"data": "[]"}}))], "artifact_id string, status int, body string")
    ids = spark.createDataFrame([(str(n),) for n in range(5, 10)], "artifact_id string")
    found = lookup_records(ids, answers)
    assert {(r["artifact_id"], r["status"], r["record"] is not None) for r in refuse(found).collect()} == {
        ("5", 200, True), ("6", 500, False), ("7", 200, False), ("8", 200, False), ("9", 404, False),
    }
    with pytest.raises(AuthRequired):
        refuse(lookup_records(ids, answers.withColumn("status", F.lit(401))))


def test_listings_of_both_forms_with_filter_and_limit(spark, tmp_path):
    root = str(tmp_path / "rest")
    write_pages(root, "a", [[item(1), item(2, tools=())], [item(3), item(4)], [], [item(5)]], form="rest")
    write_pages(root, "b", [[item(6)]], form="rest")
    spark.dataSource.register(RecordedPages)
    read = lambda **o: sorted(r["artifact_id"] for r in spark.read.format("recorded_pages").options(path=root, form="rest", **o).load().collect())
    assert read() == ["1", "2", "3", "4", "6"]  # a page without items ends its stream
    assert read(streams="a", tools="86") == ["1", "3", "4"] and read(streams="a", limit=3) == ["1", "2", "3"]
    assert read(streams="a", cursor="1", pages=1) == ["3", "4"]


def test_more_hosts_than_a_list_holds_are_all_asked(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    requests(spark, store, 403, 403, 403)
    hosts = spark.range(3000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("host"))
    crawl.check_gate(store, hosts, NOW + dt.timedelta(seconds=9))
    with pytest.raises(crawl.Latched):
        crawl.check_gate(store, hosts.unionByName(spark.createDataFrame([("files.example",)], "host string")), NOW + dt.timedelta(seconds=9))


def test_state_grows_by_appending(spark, tmp_path, monkeypatch):
    store = StateStore(spark, str(tmp_path / "state"))
    row = lambda n: spark.createDataFrame([(f"h{n}", 200)], "host string, status int")
    for n in range(3):
        store.append("requests", row(n))
    assert store._folders("requests")[1] == ["v000000001", "v000000001-000001", "v000000001-000002"] and store.read("requests").count() == 3
    monkeypatch.setattr("graphloom.sources.store.MOST_PARTS", 2)
    store.append("requests", row(3))
    assert store._folders("requests")[1] == ["v000000002"] and store.read("requests").count() == 4
    store.write("requests", store.read("requests").limit(0).unionByName(row(9), allowMissingColumns=True))
    assert [r["host"] for r in store.read("requests").collect()] == ["h9"]


def test_deadline_within_a_batch(spark):
    run = crawl._capturing(0.0)
    batch = pa.RecordBatch.from_pydict({"artifact_id": ["a", "b"], "url": ["u", "u"], "content": [b"x", b"y"]})
    assert [b.column(12).to_pylist() for b in run(iter([batch]))] == [[True, True]]
    assert [b.column(12).to_pylist() for b in crawl._capturing(None)(iter([batch]))] == [[False, False]]
