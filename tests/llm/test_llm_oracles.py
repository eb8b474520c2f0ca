"""Queries with SQL agree with it; every query has its contract's columns."""

import duckdb
import pytest

from quire.llm.oracles import ORACLES
from quire.llm.queries import QUERIES
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(repr(tuple(r[c] for c in cols)) for r in got.collect()) == sorted(
        repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_the_rest_have_none():
    assert {n.split("_")[0] for n in set(QUERIES) - set(ORACLES)} == {"op2", "op3", "op6", "op7", "op9"}
