"""The queries with an SQL twin against DuckDB, on whole tables."""

import duckdb
import pytest

from conftest import SF001
from tidepool.llm import registry
from tidepool.plans.compare import diff_rows
from tidepool.sources.tables import TABLE_NAMES

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = registry.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    assert diff_rows(df.columns, rows, rel.columns, rel.fetchall()) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
