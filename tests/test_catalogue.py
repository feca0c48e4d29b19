"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from weftline.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(x):
    if isinstance(x, Decimal):
        return round(float(x), 9)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    return str(x)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, duck, name):
    ours = catalogue.QUERIES[name](spark, DIR)
    names = sorted(ours.columns)
    theirs = duck.sql(catalogue.ORACLES[name])
    assert sorted(theirs.columns) == names
    a = sorted([plain(r[n]) for n in names].__repr__() for r in ours.collect())
    at = [theirs.columns.index(n) for n in names]
    b = sorted([plain(r[i]) for i in at].__repr__() for r in theirs.fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).count() > 0
