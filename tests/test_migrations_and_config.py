import datetime as dt
import json

import pytest

from graphloom import cli
from graphloom.config import Config, secret
from graphloom.sources import migrations, objects
from graphloom.sources.store import StateStore

NOW = dt.datetime(2026, 5, 1)


def test_statements_are_cut_outside_quotes():
    text = "-- first; not a statement\nSELECT 'a;b -- c' AS x; SELECT 2 - 1;\n;\nSELECT \"q;\" -- end"
    assert migrations.statements(text) == ["SELECT 'a;b -- c' AS x", "SELECT 2 - 1", 'SELECT "q;"']


def test_each_migration_runs_once_and_never_changes(spark, tmp_path):
    folder, store = tmp_path / "sql", StateStore(spark, str(tmp_path / "state"))
    folder.mkdir()
    with pytest.raises(migrations.MigrationError):
        migrations.migrate(spark, store, str(folder), NOW)
    (folder / "001_first.sql").write_text("CREATE OR REPLACE TEMP VIEW m1 AS SELECT 1 AS a; CREATE OR REPLACE TEMP VIEW m2 AS SELECT a + 1 AS b FROM m1")
    assert migrations.migrate(spark, store, str(folder), NOW) == ["1_first"] and spark.table("m2").head()["b"] == 2
    (folder / "003_third.sql").write_text("SELECT 1")
    (folder / "note.txt").write_text("no migration")
    assert migrations.migrate(spark, store, str(folder), NOW) == ["3_third"] and migrations.migrate(spark, store, str(folder), NOW) == []
    (folder / "002_late.sql").write_text("SELECT 1")
    with pytest.raises(migrations.MigrationError, match="before"):
        migrations.migrate(spark, store, str(folder), NOW)
    (folder / "002_late.sql").unlink()
    (folder / "001_first.sql").write_text("SELECT 2")
    with pytest.raises(migrations.MigrationError, match="changed"):
        migrations.migrate(spark, store, str(folder), NOW)
    (folder / "001_first.sql").unlink()
    with pytest.raises(migrations.MigrationError, match="missing"):
        migrations.migrate(spark, store, str(folder), NOW)


def test_a_failed_migration_is_taken_up_again(spark, tmp_path):
    folder, store = tmp_path / "sql", StateStore(spark, str(tmp_path / "state"))
    folder.mkdir()
    (folder / "1_a.sql").write_text("SELECT 1")
    (folder / "2_b.sql").write_text("SELECT nothing FROM nowhere")
    with pytest.raises(Exception, match="nowhere"):
        migrations.migrate(spark, store, str(folder), NOW)
    (folder / "2_b.sql").write_text("SELECT 2")
    assert migrations.migrate(spark, store, str(folder), NOW) == ["2_b"]


def test_secrets_come_from_files_too(tmp_path):
    (tmp_path / "key").write_text(" k3y\n")
    assert secret("X", {"X_FILE": str(tmp_path / "key")}) == "k3y" and secret("X", {"X": "direct", "X_FILE": "none"}) == "direct" and secret("X", {}) is None
    with pytest.raises(FileNotFoundError):
        secret("X", {"X_FILE": str(tmp_path / "none")})
    config = Config.from_env({"GRAPHLOOM_ROOT": "/r", "GRAPHLOOM_FILE_RATE": "2"})
    assert (config.root, config.file_rate, config.listing_rate, config.credential) == ("/r", 2.0, 1.5, None)


def test_objects_are_whole_and_put_once(tmp_path):
    for root in (str(tmp_path / "a"), f"file://{tmp_path}/b", f"file:{tmp_path}/c"):
        system, base = objects.open_root(root)
        assert objects.put(system, f"{base}/x/y.bin", b"1") and not objects.put(system, f"{base}/x/y.bin", b"2")
        assert objects.get(system, f"{base}/x/y.bin") == b"1" and objects.get(system, f"{base}/x/z") is None
        assert objects.names(system, base) == ["x"] and objects.names(system, f"{base}/none") == []
        objects.drop(system, f"{base}/x/y.bin")
        objects.drop(system, f"{base}/x/y.bin")
        assert objects.get(system, f"{base}/x/y.bin") is None
    assert [p.name for p in (tmp_path / "a" / "x").iterdir()] == []


def test_dimensions_and_migrations_by_command(spark, tmp_path, capsys):
    (tmp_path / "core.json").write_text(json.dumps({"class_types": ["A"], "inputs": {"A": ["ckpt_name"]}}))
    (tmp_path / "map.json").write_text(json.dumps({"https://h.example/o/r": [["C"]]}))
    (tmp_path / "packs.jsonl").write_text('{"pack_id": "r", "cnr_id": "r", "repo": "h.example/o/r"}\n')
    (tmp_path / "1_x.sql").write_text("SELECT 1")
    run = lambda *a: cli.main(["--root", str(tmp_path / "root"), *a], spark)
    names = [x for n, f in (("core", "core.json"), ("names", "map.json"), ("packs", "packs.jsonl"), ("dimensions", "dims")) for x in (f"--{n}", str(tmp_path / f))]
    assert run("load-dimensions", *names) == 0
    assert json.loads(capsys.readouterr().out) == {"core_classes": 1, "core_inputs": 1, "pack_nodes": 1, "packs": 1}
    lake = cli._lake(spark, cli.build_parser().parse_args(["--root", str(tmp_path / "root"), "check-schema", "--dimensions", str(tmp_path / "dims")]))
    assert lake.declared == {"A": ["ckpt_name"]}
    assert run("migrate", "--migrations", str(tmp_path)) == 0 and json.loads(capsys.readouterr().out) == {"ran": ["1_x"]}
