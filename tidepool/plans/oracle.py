"""DuckDB SQL twins of the catalogue queries.

Each string runs on the given Parquet tables registered as views under their names and
returns the same columns (names and values) as the Spark query of the same key.
"""

from __future__ import annotations

from tidepool.plans.batch import BUCKET_SECONDS, HOURLY_VALUE_RANGE

_LO, _HI = HOURLY_VALUE_RANGE

# D5 hot key, the same integer rule as `tidepool.functions.scalar.hot_key`.
HOT_KEY_SQL = "CASE WHEN l_orderkey % 10 < 9 THEN 0 ELSE l_orderkey % 99 + 1 END"

_SKEWED = f"SELECT l_orderkey, l_extendedprice, l_quantity, CAST({HOT_KEY_SQL} AS BIGINT) AS join_key FROM lineitem"

_JOIN = f"""
SELECT 'key_' || CAST(s.join_key AS VARCHAR) AS label, count(*) AS n, round(avg(s.l_extendedprice), 6) AS avg_price
FROM ({_SKEWED}) s JOIN range(0, 100) r(join_key) ON s.join_key = r.join_key
GROUP BY 1
"""

BATCH_SQL: dict[str, str] = {
    "hourly_summary": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS n,
       round(avg(value), 6) AS avg_value,
       round(avg(CAST(json_extract_string(props, '$.k') AS INTEGER)), 6) AS avg_k
FROM events WHERE value BETWEEN {_LO} AND {_HI}
GROUP BY 1, 2 ORDER BY 1, 2
""",
    "minmax_ts": "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events",
    "describe_lineitem": """
SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS stddev, CAST(min(l_quantity) AS DOUBLE) AS min_value,
       CAST(max(l_quantity) AS DOUBLE) AS max_value FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6),
       round(stddev_samp(l_extendedprice), 6), CAST(min(l_extendedprice) AS DOUBLE),
       CAST(max(l_extendedprice) AS DOUBLE) FROM lineitem
""",
    "count_by_flag": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_returnflag",
    "count_by_two_keys": """
SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS n FROM orders
GROUP BY 1, 2 ORDER BY n DESC, 1, 2
""",
    "count_by_two_keys_one_value": """
SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS n FROM orders WHERE o_orderstatus = 'F'
GROUP BY 1, 2 ORDER BY n DESC, 1, 2
""",
    "avg_by_key": "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS avg_acctbal FROM customer GROUP BY 1",
    "global_avg": "SELECT count(*) AS n, round(avg(c_acctbal), 6) AS avg_acctbal FROM customer",
    "dedup_latest": """
SELECT user_id, event_type, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC) AS rn
  FROM events) WHERE rn = 1
""",
    "distinct_pairs": "SELECT DISTINCT user_id, event_type FROM events",
    "time_buckets": f"""
SELECT time_bucket(INTERVAL '{BUCKET_SECONDS} seconds', ts) AS window_start,
       time_bucket(INTERVAL '{BUCKET_SECONDS} seconds', ts) + INTERVAL '{BUCKET_SECONDS} seconds' AS window_end,
       count(*) AS n, round(sum(value), 6) AS sum_value, max(value) AS max_value
FROM events GROUP BY 1, 2
""",
    "sum_or_zero_empty": "SELECT COALESCE(sum(value), 0.0) AS total_value FROM events WHERE value < 0",
    "group_by_flag": "SELECT o_totalprice > 100000 AS high_value, count(*) AS n FROM orders GROUP BY 1",
    "priority_set": """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2 ORDER BY 1, 2
""",
    "top_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "order_revenue_by_segment": """
SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS n, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2
""",
    "heavy_hitters": """
SELECT l_suppkey, count(*) AS rows, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share FROM lineitem GROUP BY 1
HAVING count(*) >= 0.01::DOUBLE * (SELECT count(*) FROM lineitem)
""",
    "skew_report": f"""
SELECT join_key, rows, round(rows / sum(rows) OVER (), 6) AS share FROM (
  SELECT join_key, count(*) AS rows FROM ({_SKEWED}) GROUP BY 1)
ORDER BY rows DESC, join_key
""",
    "join_plain": _JOIN,
    "join_broadcast": _JOIN,
    "join_salted": _JOIN,
    "key_balance": f"""
SELECT min(rows) AS min_rows, round(CAST(median(rows) AS DOUBLE), 3) AS median_rows, max(rows) AS max_rows,
       round(max(rows) / median(rows), 3) AS max_over_median
FROM (SELECT join_key, count(*) AS rows FROM ({_SKEWED}) GROUP BY 1)
""",
    "conform_schema": """
SELECT p_partkey AS part_key, p_name AS title, p_brand AS brand, COALESCE(p_size, 0) AS size,
       p_retailprice AS retail_price, 'USD' AS currency FROM part
""",
    "split_totals": """
SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys, min(o_orderkey) AS min_key,
       max(o_orderkey) AS max_key FROM orders
""",
}

BATCH_SQL.update({
    "file_stats": """
SELECT 'lineitem.parquet' AS file_name, count(*) AS rows, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key
FROM lineitem
""",
    "newest_events": "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20",
    "shuffled_orders": "SELECT o_orderkey, o_totalprice FROM orders",
    "cast_rename_lineitem": """
SELECT l_shipdate AS ship_ts, CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price,
       l_discount AS discount, l_returnflag AS return_flag, l_orderkey AS order_key FROM lineitem
""",
    "discount_ratio": """
SELECT l_orderkey, l_linenumber, l_discount, l_tax,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS discount_per_tax FROM lineitem
""",
    "size_classes": """
SELECT CASE WHEN l_quantity IS NULL THEN 'unknown'
            WHEN l_quantity > 25 AND NOT (l_returnflag = 'R') THEN 'large' ELSE 'small' END AS size_class,
       count(*) AS n FROM lineitem GROUP BY 1
""",
    "props_struct": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
})
