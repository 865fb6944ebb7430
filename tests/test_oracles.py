"""Every query with SQL agrees with DuckDB at the smallest scale."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb
import pytest

from quern.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.6f}" if isinstance(v, (int, float, Decimal)) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(tuple(plain(row[c]) for c in columns) for row in got.collect()) == want
    spark.catalog.clearCache()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
