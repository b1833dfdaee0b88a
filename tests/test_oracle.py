"""Every catalogue query against its DuckDB twin on the smallest data set (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tidepool.plans import registry
from tidepool.plans.compare import diff_rows
from tidepool.sources.tables import TABLE_NAMES

from conftest import SF001

SQL = registry.oracle_sql()
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    assert diff_rows(df.columns, rows, rel.columns, rel.fetchall()) == []


# The order of a result is part of these queries; the comparison above sorts both sides.
ORDERED = {"count_by_flag": [("n", False), ("l_returnflag", True)], "top_orders": [("o_totalprice", False)],
           "priority_set": [("o_orderpriority", True), ("o_orderstatus", True)], "skew_report": [("rows", False), ("join_key", True)]}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order_of_rows(spark, name):
    rows = [r.asDict() for r in registry.queries()[name](spark, SF001).collect()]
    want = rows
    for column, ascending in reversed(ORDERED[name]):
        want = sorted(want, key=lambda r: r[column], reverse=not ascending)
    assert [[r[c] for c, _ in ORDERED[name]] for r in rows] == [[r[c] for c, _ in ORDERED[name]] for r in want]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "event_type", "n", "avg_value", "avg_k"]


def test_changed_input_is_built_anew(spark, scratch):
    from tidepool.plans.memo import built_once

    root = scratch.replace("file:", "")
    spark.range(3).write.parquet(f"{root}/events.parquet")
    runs = []
    for _ in range(2):
        built_once(spark, root, "probe", ("events",), lambda: runs.append(1))
    spark.range(4).write.mode("append").parquet(f"{root}/events.parquet")
    built_once(spark, root, "probe", ("events",), lambda: runs.append(1))
    assert len(runs) == 2
