"""Queries with an oracle against DuckDB on the smoke tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tidesync.llm import queries as llm
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in llm.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert {*llm.QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = llm.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(llm.ORACLE[name])
    expected = cur.fetchall()
    assert digest(df.columns, rows) == digest([d[0] for d in cur.description], expected)
