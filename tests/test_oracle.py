"""Registered queries against their DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tarmac.plans import oracle, registry
from tarmac.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(entry.oracle_sql()[name])
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    assert cols == sorted(rel.columns)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "avg_delay_mins"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
