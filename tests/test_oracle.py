"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fabline.plans.registry import ORACLE, QUERIES
from fabline.sources.tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"

SQL = ORACLE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(SQL[name])
    dcols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, got) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "fire_seq" in df.columns
