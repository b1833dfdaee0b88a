"""Catalogue queries that take a given table through a source or sink and read it back
(S1, S2, S4-S7, S10, S14, S16, K5, K18, D2, A8, A9, F12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.scalar import nan_to_null
from tidepool.operators import aggregate as A
from tidepool.operators import layout as LY
from tidepool.operators import sinks as K
from tidepool.session import work_dir
from tidepool.sources import tables as S

LINE_BYTES = 128  # no line of the fixture is longer
FILE_PARTS = 7
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of the rows without a value
PARTITIONS = 11
ROWS_PER_FILE = 1_000_000


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as CSV with a header, read with an inferred schema."""
    path = f"{work_dir(spark, 'csv')}/orders"
    _plain_orders(spark, sf_dir).write.option("header", True).csv(path)
    back = S.read_csv(spark, path)
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def csv_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a fixed schema (no inference pass)."""
    path = f"{work_dir(spark, 'csv')}/orders"
    _plain_orders(spark, sf_dir).write.option("header", True).csv(path)
    return S.read_csv(spark, path, schema="o_orderkey bigint, o_orderstatus string, o_totalprice double")


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as JSON lines, read with an inferred schema."""
    path = f"{work_dir(spark, 'json')}/orders"
    K.write_json(_plain_orders(spark, sf_dir), path)
    return S.read_json(spark, path).select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def _plain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def status_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per status, named by a table of local rows; an empty table of the same schema
    adds nothing."""
    rows = [("F", "finished"), ("O", "open"), ("P", "partial")]
    names = S.from_rows(spark, rows, "status string, name string")
    names = names.unionByName(S.empty_like(spark, names.schema))
    counts = S.read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return names.join(counts, "status", "left").select("status", "name", F.coalesce("n", F.lit(0)).alias("n"))


def split_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as JSON lines, a folder per status, written by all tasks and read in splits of
    an eighth of the largest file: per folder the rows and keys of its splits, whether some file had several, and the bytes of
    its files that no split covered or two did."""
    path = f"{work_dir(spark, 'splits')}/orders"
    o = S.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    o.write.partitionBy("o_orderstatus").option("maxRecordsPerFile", ROWS_PER_FILE).json(path)
    largest = LY.list_files(spark, path, "*.json").agg(F.max("file_bytes")).first()[0] or 0
    rows = S.read_split(spark, path, max(8 * LINE_BYTES, largest // 8), "json", "o_orderkey long, o_totalprice double, o_orderstatus string")
    splits = LY.split_audit(rows, "o_orderkey", ["o_orderstatus"])
    files = LY.split_coverage(splits, ["o_orderstatus"], LINE_BYTES).groupBy("o_orderstatus").agg(
        (F.max("splits") > 1).alias("was_split"), F.sum("gap_bytes").alias("gap_bytes"), F.sum("overlap_bytes").alias("overlap_bytes"))
    keys = splits.groupBy("o_orderstatus").agg(F.sum("rows").alias("rows"), F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"))
    return keys.join(files, "o_orderstatus")


def capped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` written by many tasks, a folder per status, with at most a seventh of the rows a file: per
    folder its files, rows and largest file, and whether each file keeps to the cap and there are as many as
    it takes.  Rows are numbered within their status and dealt to the tasks by whole files, so all files of
    a folder but one are full, whatever the number of tasks."""
    path = f"{work_dir(spark, 'capped')}/orders"
    o = S.read_table(spark, sf_dir, "orders")
    cap = max(1, -(-o.count() // FILE_PARTS))
    dealt = LY.numbered(o, ["o_orderstatus"]).withColumn(LY.NUMBER, F.floor(F.col(LY.NUMBER) / cap)).repartition("o_orderstatus", LY.NUMBER).drop(LY.NUMBER)
    K.write_parquet(dealt, path, max_records_per_file=cap, partition_by=["o_orderstatus"])
    status = F.regexp_extract("file_path", "o_orderstatus=([^/]+)/", 1)
    files = LY.partition_report(spark, path)[0].withColumn("o_orderstatus", F.when(status != NO_VALUE, status))
    return files.groupBy("o_orderstatus").agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.max("rows").alias("largest"), F.bool_and(F.col("rows").between(1, cap)).alias("kept_to_cap"),
        (F.count("*") >= F.ceil(F.sum("rows") / cap)).alias("enough_files"))


def sum_or_zero_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum over rows that are there (its other half is `sum_or_zero_empty`)."""
    return A.sum_or_zero(S.read_table(spark, sf_dir, "lineitem"), "l_orderkey", "total")


def partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and key range of each partition of `lineitem`, dealt out by key."""
    li = S.read_table(spark, sf_dir, "lineitem").repartitionById(PARTITIONS, (F.col("l_orderkey") % PARTITIONS).cast("int"))
    return A.rows_per_partition(li, "l_orderkey")


def nan_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`value` with NaN in every fiftieth event, counted and averaged after NaN became NULL."""
    v = F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    ev = S.read_table(spark, sf_dir, "events").select("event_type", nan_to_null(v).alias("value"))
    return ev.groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("with_value"), F.round(F.avg("value"), 6).alias("avg_value"))


def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files of `orders` by the scan's hidden metadata, every row with its file."""
    o = S.with_file_metadata(S.read_table(spark, sf_dir, "orders"))
    whole = (F.col("_file_size") > 0) & F.col("_file_path").endswith(F.col("_file_name")) & F.col("_file_mtime").isNotNull()
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(whole).alias("with_file"))


_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM orders"

SOURCES_SQL = {
    "csv_inferred": _ORDERS,
    "csv_with_schema": _ORDERS,
    "json_round_trip": _ORDERS,
    "status_names": """
SELECT status, name, count(o_orderkey) AS n FROM (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) t(status, name)
LEFT JOIN orders ON o_orderstatus = status GROUP BY 1, 2
""",
    "split_audit": """
SELECT o_orderstatus, true AS was_split, count(*) AS rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, 0 AS gap_bytes, 0 AS overlap_bytes
FROM orders GROUP BY 1
""",
    "capped_files": f"""
WITH c AS (SELECT CAST(ceil(count(*) / {FILE_PARTS}) AS BIGINT) AS cap FROM orders)
SELECT o_orderstatus, CAST(ceil(count(*) / any_value(cap)) AS BIGINT) AS files, count(*) AS rows, least(count(*), any_value(cap)) AS largest,
       true AS kept_to_cap, true AS enough_files
FROM orders, c GROUP BY 1
""",
    "sum_or_zero_value": "SELECT sum(l_orderkey)::BIGINT AS total FROM lineitem",
    "partition_rows": f"""
SELECT CAST(l_orderkey % {PARTITIONS} AS INTEGER) AS partition_id, count(*) AS rows, min(l_orderkey) AS min_value, max(l_orderkey) AS max_value
FROM lineitem GROUP BY 1
""",
    "nan_values": """
SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 50 <> 0) AS with_value, round(avg(value) FILTER (event_id % 50 <> 0), 6) AS avg_value
FROM events GROUP BY 1
""",
    "file_metadata": "SELECT o_orderstatus, count(*) AS n, count(*) AS with_file FROM orders GROUP BY 1",
}
