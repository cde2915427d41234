import glob
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from graphloom.session import build_session, ship_package  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


def text(value):
    """Comparable text of a value of either engine."""
    if value is None or isinstance(value, float) and value != value or str(value) in ("NaT", "<NA>"):
        return "null"
    if isinstance(value, float):
        return f"{value:.6g}"
    if hasattr(value, "tolist"):
        value = value.tolist()
    return str(value)


def rows(frame):
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(text(v) for v in row) for row in ordered.itertuples(index=False))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="session")
def same(spark, duck):
    """Compare a query with its SQL on the smallest tables."""
    def check(module, name):
        got = module.QUERIES[name](spark, SMALL).toPandas()
        if name in module.SQL:
            want = duck.execute(module.SQL[name]).df()
            assert sorted(want.columns) == sorted(got.columns)
            assert rows(want) == rows(got)
        return got

    return check
