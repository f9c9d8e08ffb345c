"""Every registered query against its DuckDB oracle on the smoke tables (the driver runs sf0.01)."""

import duckdb
import pytest

from conftest import SF_SMOKE

import __spark_entry__ as E
from tidesync.plans import catalog
from tools.oracle_check import TABLES, digest

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["partition_num", "n_rows"]
    assert df.count() > 0


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_every_query_has_an_oracle_or_a_reason():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"nested_to_json_floats"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
