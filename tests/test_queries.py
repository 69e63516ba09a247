"""Registered queries against their DuckDB oracles, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from blocklog.catalog import QUERIES

TABLES = "events documents pages".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toArrow()
    want = duck.execute(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = [sorted(map(str, t.select(columns).to_pylist())) for t in (got, want)]
    assert rows[0] == rows[1]
