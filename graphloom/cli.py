"""Commands. Results go to standard output as JSON; exit code 2 is a latched host, 1 an error;
backing off is no error."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from graphloom.config import Config
from graphloom.functions.graph import CANVAS_CLASSES, LOADER_INPUTS
from graphloom.plans import crawl
from graphloom.plans.ingest import Lake
from graphloom.schemas import ENUMS, TABLES
from graphloom.session import build_session, ship_package
from graphloom.sources import dimensions, migrations
from graphloom.sources.pages import RecordedPages
from graphloom.sources.shared import exists
from graphloom.sources.store import STATE, StateStore


def _lake(spark: SparkSession, args: argparse.Namespace) -> Lake:
    at = args.dimensions.rstrip("/")
    read = lambda name: spark.read.parquet(f"{at}/{name}.parquet")
    inputs = f"{at}/core_inputs.parquet"
    declared = dimensions.declared_inputs(spark.read.parquet(inputs)) if exists(spark, inputs) else None
    return Lake(spark, f"{args.root}/lake", read("core_classes"), read("pack_nodes"), read("packs"), declared)


def load_dimensions(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Published documents as the dimension tables that the other commands read."""
    classes, inputs = dimensions.core_document(spark, args.core)
    tables = {"core_classes": classes, "core_inputs": inputs, "pack_nodes": dimensions.name_map(spark, args.names), "packs": dimensions.pack_lines(spark, args.packs)}
    counts = {}
    for name, rows in tables.items():
        at = f"{args.dimensions.rstrip('/')}/{name}.parquet"
        rows.write.mode("overwrite").parquet(at)
        counts[name] = spark.read.parquet(at).count()
    return counts


def _pages(spark: SparkSession, args: argparse.Namespace):
    spark.dataSource.register(RecordedPages)
    return spark.read.format("recorded_pages").option("path", args.pages).load()


def selftest(spark: SparkSession) -> dict:
    """What the package must carry is there and can be read by Spark."""
    for name, schema in {**{n: s.schema for n, s in TABLES.items()}, **STATE}.items():
        if not spark.createDataFrame([], schema).columns:
            raise RuntimeError(f"{name} has no columns")
    counts = {"tables": len(TABLES), "state_tables": len(STATE), "canvas_classes": len(CANVAS_CLASSES), "loader_inputs": len(LOADER_INPUTS), "enumerations": len(ENUMS)}
    if not all(counts.values()):
        raise RuntimeError(f"something is empty: {counts}")
    return counts | {"ok": True}


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="graphloom")
    config = Config.from_env()
    parser.add_argument("--root", default=config.root)
    parser.add_argument("--source", default=config.source)
    parser.add_argument("--now", type=dt.datetime.fromisoformat, default=None, help="time to judge leases and limits at, UTC")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, run: Callable, **options) -> None:
        sub = commands.add_parser(name)
        for option, settings in options.items():
            sub.add_argument(f"--{option.replace('_', '-')}", **settings)
        sub.set_defaults(run=run)

    number = lambda n: {"type": int, "default": n}
    flag = {"action": "store_true"}
    modes = lambda d: {"choices": ["complete", "tagged", "all"], "default": d}
    folder = {"required": True}
    command("check-schema", lambda s, a, now: {"drift": _lake(s, a).repair() if a.repair else _lake(s, a).check()}, dimensions=folder, repair=flag)
    command("migrate", lambda s, a, now: {"ran": migrations.migrate(s, _store(s, a), a.migrations, now)}, migrations=folder)
    command("load-dimensions", lambda s, a, now: load_dimensions(s, a), core=folder, names=folder, packs=folder, dimensions=folder)
    command(
        "discover-tip", lambda s, a, now: crawl.discover_tip(_store(s, a), _pages(s, a), a.source, now, a.mode, a.max_pages, not a.every_asset),
        pages=folder, mode=modes("complete"), max_pages=number(crawl.TIP_PAGES), every_asset=flag,
    )
    command(
        "discover-backlog",
        lambda s, a, now: crawl.discover_backlog(_store(s, a), _pages(s, a), a.source, now, a.mode, a.partitions, a.max_pages, not a.every_asset),
        pages=folder, mode=modes("tagged"), partitions=number(5), max_pages=number(crawl.TIP_PAGES), every_asset=flag,
    )
    command(
        "fetch",
        lambda s, a, now: crawl.fetch(
            _store(s, a), s.read.parquet(a.files), a.source, f"{a.root}/bucket", now, a.batch, not a.no_prefix,
            now + dt.timedelta(seconds=a.deadline_seconds) if a.deadline_seconds is not None else None, s.read.parquet(a.api) if a.api else None,
        ),
        files=folder, api={"default": None}, batch=number(200), no_prefix=flag, deadline_seconds={"type": float, "default": None},
    )
    command("ingest", lambda s, a, now: _lake(s, a).ingest(f"{a.root}/bucket", a.limit), dimensions=folder, limit=number(None))
    command("gc", lambda s, a, now: crawl.collect_garbage(_store(s, a), f"{a.root}/bucket", now, a.limit), limit=number(1000))
    command("unlatch", lambda s, a, now: crawl.unlatch(_store(s, a), a.host, a.by, now), host=folder, by={"default": os.environ.get("USER", "unknown")})
    command("selftest", lambda s, a, now: selftest(s))
    command("status", lambda s, a, now: crawl.status(_store(s, a), a.source))
    return parser


def _store(spark: SparkSession, args: argparse.Namespace) -> StateStore:
    return StateStore(spark, f"{args.root}/state")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    session = spark or build_session()
    ship_package(session)
    now = args.now or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    try:
        result, code = args.run(session, args, now), 0
    except crawl.Latched as stop:
        result, code = {"latched": str(stop)}, 2
    except crawl.BackingOff as stop:
        result, code = {"backing_off": str(stop)}, 0
    except Exception as problem:
        result, code = {"error": f"{type(problem).__name__}: {problem}"}, 1
    print(json.dumps(result, default=str), file=sys.stderr if code else sys.stdout)
    return code


if __name__ == "__main__":
    raise SystemExit(main())
