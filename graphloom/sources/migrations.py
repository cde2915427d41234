"""Ordered schema migrations from SQL files, each run once and never changed afterwards."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from pathlib import Path

from pyspark.sql import SparkSession

from graphloom.sources.store import StateStore

FILE = re.compile(r"(\d+)_(\w+)\.sql")
_PIECE = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|;|[^'\";-]+|-", re.S)


class MigrationError(RuntimeError):
    """A file was changed after it ran, is missing, or its number comes twice."""


def statements(text: str) -> list[str]:
    """The statements of a file: comments gone, cut at semicolons that are not in quotes."""
    found, current = [], ""
    for piece in _PIECE.findall(text):
        if piece == ";":
            found.append(current)
            current = ""
        elif not piece.startswith("--"):
            current += piece
    return [s.strip() for s in [*found, current] if s.strip()]


def load(folder: str) -> list[tuple[int, str, str]]:
    """(number, name, text) of the files of a folder on the driver's machine, in order. None is an error:
    a folder that is empty by mistake would pass as up to date."""
    files = sorted((int(m[1]), m[2], p.read_text(encoding="utf-8")) for p in Path(folder).iterdir() if (m := FILE.fullmatch(p.name)))
    if not files:
        raise MigrationError(f"no migration in {folder}")
    numbers = [n for n, _, _ in files]
    if len(set(numbers)) < len(numbers):
        raise MigrationError(f"a number comes twice: {numbers}")
    return files


def checksum(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def migrate(spark: SparkSession, store: StateStore, folder: str, now: dt.datetime) -> list[str]:
    """Run the migrations that have not run, in order, each noted after its last statement; the names of
    those. Statements must bear being run again: a run that died is taken up at the file it died in."""
    files = load(folder)
    ran = {r["number"]: (r["name"], r["checksum"]) for r in store.read("migrations").collect()}  # one row a file
    for number, (name, mark) in sorted(ran.items()):
        now_there = {n: checksum(t) for n, _, t in files}.get(number)
        if now_there != mark:
            raise MigrationError(f"{number}_{name} {'is missing' if now_there is None else 'was changed after it ran'}")
    if any(number < max(ran, default=0) for number, _, _ in files if number not in ran):
        raise MigrationError("a new migration has a number before one that ran")
    done = []
    for number, name, text in files:
        if number not in ran:
            for statement in statements(text):
                spark.sql(statement)
            store.append("migrations", spark.createDataFrame([(number, name, checksum(text), now)], "number int, name string, checksum string, applied_at timestamp"))
            done.append(f"{number}_{name}")
    return done
