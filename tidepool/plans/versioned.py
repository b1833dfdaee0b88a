"""Catalogue queries over a versioned copy of `customer`.

The version chain, built once per application and state of the input:

    0 CREATE    customer, three files by key range
    1 WRITE     append: every supplier as a customer (keys offset into their own range)
    2 DELETE    customers with a negative balance
    3 UPDATE    AUTOMOBILE customers renamed with a `vip_` prefix
    4 RESTORE   back to version 0
    5 OPTIMIZE  compaction of the small files
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import digest_tree as D
from tidepool.plans.memo import built_once
from tidepool.session import work_dir
from tidepool.sources.tables import read_table
from tidepool.versioned.table import VersionedTable, new_table_root

SUPPLIER_KEY_OFFSET = 1_000_000_000
ROWS_PER_FILE = 1_000_000
DELETE_PREDICATE = "c_acctbal < 0"
UPDATE_PREDICATE = "c_mktsegment = 'AUTOMOBILE'"
UPDATE_SET = {"c_name": "concat('vip_', c_name)"}
SKIP_RANGE = (1000, 4999)

def suppliers_as_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select((F.col("s_suppkey") + SUPPLIER_KEY_OFFSET).alias("c_custkey"), F.col("s_name").alias("c_name"),
                    F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                    F.lit("SUPPLIER").alias("c_mktsegment"))


def customer_chain(spark: SparkSession, sf_dir: str) -> VersionedTable:
    def build() -> VersionedTable:
        t = VersionedTable(spark, new_table_root(spark, "customer-versions"), "c_custkey")
        cust = read_table(spark, sf_dir, "customer")
        # Three key-range files at small scale; about ROWS_PER_FILE rows per file beyond that.
        t.create(cust, files=max(3, -(-cust.count() // ROWS_PER_FILE)))
        t.append(suppliers_as_customers(spark, sf_dir))
        t.delete(DELETE_PREDICATE)
        t.update(UPDATE_PREDICATE, UPDATE_SET)
        t.restore(0)
        t.compact()
        return t

    return built_once(spark, sf_dir, "versions", ("customer", "supplier"), build)


def version_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 V6: the history, with the rows of every version counted by reading its files."""
    t = customer_chain(spark, sf_dir)
    counts = None
    for v in range(t.latest_version() + 1):  # one count per commit of the chain
        one = t.read(v).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(v).alias("v"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return t.history().join(counts, F.col("version") == F.col("v")).select(F.col("version").cast("int").alias("version"), "operation", "rows")


def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: every commit with what it says it did: rows written, deleted or updated."""
    m = F.col("metrics")
    rows = F.coalesce(F.try_element_at(m, F.lit("numDeletedRows")), F.try_element_at(m, F.lit("numUpdatedRows")), F.try_element_at(m, F.lit("numOutputRows")))
    return customer_chain(spark, sf_dir).history().select(
        F.col("version").cast("int").alias("version"), "operation", F.col("readVersion").alias("read_version"),
        F.col("isBlindAppend").alias("blind_append"), F.col("data_change"), rows.cast("long").alias("rows_changed"))


def time_travel_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: the table as of the moment version 2 (the delete) was committed."""
    t = customer_chain(spark, sf_dir)
    at = t.history().where("operation = 'DELETE'").select("ts").first()[0]
    return t.read(timestamp=at)


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows removed between versions 1 and 2 (the delete)."""
    return customer_chain(spark, sf_dir).diff(1, 2)


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: the table as of version 3 (after the update)."""
    return customer_chain(spark, sf_dir).read(3)


def restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: the table after restoring version 0."""
    return customer_chain(spark, sf_dir).read(4)


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after compaction: the same rows as before it."""
    return customer_chain(spark, sf_dir).read(5)


def versioned_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key-range read of version 3 that opens only files whose min/max overlap."""
    return customer_chain(spark, sf_dir).read(3, key_range=SKIP_RANGE)


_CUST = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_SUPP = (f"SELECT s_suppkey + {SUPPLIER_KEY_OFFSET} AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, "
         "s_acctbal AS c_acctbal, 'SUPPLIER' AS c_mktsegment FROM supplier")
_V1 = f"({_CUST} UNION ALL {_SUPP})"
_V2 = f"(SELECT * FROM {_V1} WHERE NOT coalesce({DELETE_PREDICATE}, false))"
_V3 = (f"(SELECT c_custkey, CASE WHEN coalesce({UPDATE_PREDICATE}, false) THEN 'vip_' || c_name ELSE c_name END "
       f"AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM {_V2})")

RANGE_KEYS = 1_000_000  # of a range; fewer while that would be under 64 ranges


def table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` against a copy in which some prices changed, some orders are gone and some stand
    twice: found from the digest trees of both, only the key ranges that differ are read."""
    root = work_dir(spark, "digests")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    width = min(RANGE_KEYS, max(256, o.count() // 64))
    other = o.where(~key.between(300, 320)).withColumn("o_totalprice", F.when(key.between(100, 150), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    other = other.unionByName(o.where(key.between(900, 910)))
    D.write_ranges(o, f"{root}/before", "o_orderkey", width)
    D.write_ranges(other, f"{root}/after", "o_orderkey", width)
    return D.table_diff(spark, f"{root}/before", f"{root}/after")


VERSIONED_SQL = {
    "table_changes": """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
c AS (SELECT * FROM a WHERE o_orderkey BETWEEN 100 AND 150)
SELECT 'removed' AS change, *, 1 AS n FROM c UNION ALL SELECT 'added', o_orderkey, o_orderstatus, o_totalprice + 1, 1 FROM c
UNION ALL SELECT 'removed', *, 1 FROM a WHERE o_orderkey BETWEEN 300 AND 320 UNION ALL SELECT 'added', *, 1 FROM a WHERE o_orderkey BETWEEN 900 AND 910
""",
    "version_row_counts": f"""
SELECT 0 AS version, 'CREATE' AS operation, (SELECT count(*) FROM customer) AS rows
UNION ALL SELECT 1, 'WRITE', (SELECT count(*) FROM {_V1})
UNION ALL SELECT 2, 'DELETE', (SELECT count(*) FROM {_V2})
UNION ALL SELECT 3, 'UPDATE', (SELECT count(*) FROM {_V3})
UNION ALL SELECT 4, 'RESTORE', (SELECT count(*) FROM customer)
UNION ALL SELECT 5, 'OPTIMIZE', (SELECT count(*) FROM customer)
""",
    "version_history": f"""
SELECT 0 AS version, 'CREATE' AS operation, NULL::BIGINT AS read_version, false AS blind_append, true AS data_change, (SELECT count(*) FROM customer) AS rows_changed
UNION ALL SELECT 1, 'WRITE', 0, true, true, (SELECT count(*) FROM supplier)
UNION ALL SELECT 2, 'DELETE', 1, false, true, (SELECT count(*) FROM {_V1} WHERE {DELETE_PREDICATE})
UNION ALL SELECT 3, 'UPDATE', 2, false, true, (SELECT count(*) FROM {_V2} WHERE {UPDATE_PREDICATE})
UNION ALL SELECT 4, 'RESTORE', 3, false, true, NULL
UNION ALL SELECT 5, 'OPTIMIZE', 4, false, false, NULL
""",
    "time_travel_by_time": f"SELECT * FROM {_V2}",
    "version_diff": f"SELECT *, 'removed' AS _change FROM {_V1} WHERE coalesce({DELETE_PREDICATE}, false)",
    "time_travel": f"SELECT * FROM {_V3}",
    "restore": _CUST,
    "compact": _CUST,
    "versioned_skip": f"SELECT * FROM {_V3} WHERE c_custkey BETWEEN {SKIP_RANGE[0]} AND {SKIP_RANGE[1]}",
}
