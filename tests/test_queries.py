"""Every query with SQL gives DuckDB's rows, and every other one runs, over the smallest tables."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from millrace.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't there")


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 5)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = registry.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(df.columns)
        order = [names.index(c) for c in df.columns]
        expected = [tuple(plain(r[i]) for i in order) for r in want.fetchall()]
        assert sorted(map(str, expected)) == sorted(str(tuple(map(plain, r))) for r in rows)
    else:
        assert df.columns


def test_flagship(spark):
    assert registry.flagship(spark, FOLDER).count() > 0
