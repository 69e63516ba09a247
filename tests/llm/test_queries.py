"""Registered text queries: names, and those that SQL can express against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from blocklog.llm.queries import ORACLES


def test_each_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got, want = entry.queries()[name](spark, sf_dir).toArrow(), con.execute(ORACLES[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert sorted(map(str, got.select(columns).to_pylist())) == sorted(map(str, want.select(columns).to_pylist()))
