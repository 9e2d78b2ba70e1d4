"""A session for all tests, and the driver's tables in DuckDB."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from reelspark.session import local_session

    session = local_session(cores=8, partitions=8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in os.listdir(DATA):
        path = f"{DATA}/{name}" + ("/*.parquet" if os.path.isdir(f"{DATA}/{name}") else "")
        connection.execute(f"create view {name.split('.')[0]} as select * from '{path}'")
    return connection


@pytest.fixture(scope="session")
def same(duck):
    """Whether a DataFrame and SQL give the same rows under the same names and types."""
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

    def check(df, sql):
        found = duck.sql(sql)
        names = sorted(df.columns)
        assert sorted(found.columns) == names
        kinds = dict(zip(found.columns, map(str, found.types), strict=True))
        assert {n: types.get(t, t) for n, t in df.dtypes} == kinds
        order = [found.columns.index(n) for n in names]
        there = sorted(repr(tuple(r[k] for k in order)) for r in found.fetchall())
        here = sorted(repr(tuple(r)) for r in df.select(*[f"`{n}`" for n in names]).collect())
        assert here == there

    return check
