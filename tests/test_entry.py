"""Driver contract: entry() runs; every query agrees with its DuckDB oracle
at sf0.001 (the driver checks sf0.01)."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from quire.plans.queries import QUERIES
from tests.conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "paper_id", "abstract", "conclusion", "status"]
    assert df.count() > 0


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF0001}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle_but_conversion():
    assert set(QUERIES) - set(E.oracle_sql()) == {"converted_pages"}
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(query_runs, duck, name):
    columns, got, _ = query_runs[name]
    if name not in E.oracle_sql():
        assert len(got) > 0
        return
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(columns) == sorted(res.columns)
    idx = [res.columns.index(c) for c in columns]
    a = sorted((tuple(norm(v) for v in r) for r in got), key=repr)
    b = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b
