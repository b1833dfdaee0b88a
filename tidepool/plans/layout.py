"""Catalogue queries for layout, catalogs and cross-database SQL.

Each writes a copy of a given table into a fresh folder under the shared work folder, then
reports on it with Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import layout as LY
from tidepool.operators.sinks import write_parquet
from tidepool.session import work_dir
from tidepool.sources import catalog as K
from tidepool.sources.tables import read_events, read_table
from tidepool.plans.batch import HOURLY_VALUE_RANGE

MIN_REPORT_FILES = 4
ROWS_PER_FILE = 1_000_000


def report_file_count(rows: int) -> int:
    """Files for a copy of `rows` rows: at least four, about ROWS_PER_FILE rows each."""
    return max(MIN_REPORT_FILES, -(-rows // ROWS_PER_FILE))


def partition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` dealt by key to files of about a million rows (at least four) and read back: for each
    file on disk its number, its rows by the listing and by the tasks that read it."""
    path = f"{work_dir(spark, 'layout')}/orders"
    o = read_table(spark, sf_dir, "orders")
    n = report_file_count(o.count())
    write_parquet(o.repartitionById(n, (F.col("o_orderkey") % n).cast("int")), path)
    files, parts, _ = LY.partition_report(spark, path)
    read = parts.select("partition_id", "rows", F.explode("files_read").alias("file_path"))
    shared = read.groupBy("file_path").agg(F.count("*").alias("tasks"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("file")
    return files.join(shared, "file_path", "left").select(number, "rows", F.coalesce(F.col("tasks") >= 1, F.lit(False)).alias("was_read"))


def dir_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` written partitioned by status straight from the scan (no shuffle:
    a status holding a third of the rows is spread over all write tasks); per folder the
    rows, min and max key from the files' rows, and whether the listing and the scan agree
    on the folder's file count."""
    path = f"{work_dir(spark, 'layout')}/orders_by_status"
    o = read_table(spark, sf_dir, "orders")
    o.write.partitionBy("o_orderstatus").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    stats = (spark.read.parquet(path)
             .groupBy("o_orderstatus", F.col("_metadata.file_path").alias("file_path"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("min_key"),
                  F.max("o_orderkey").alias("max_key")))
    per_dir = (stats.groupBy("o_orderstatus")
               .agg(F.count(F.lit(1)).alias("files_read"), F.sum("rows").alias("rows"),
                    F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key")))
    listed = (LY.bytes_per_directory(spark, path)
              .select(F.regexp_extract("directory", r"o_orderstatus=([^/]+)$", 1).alias("o_orderstatus"),
                      F.col("files").alias("files_listed")))
    return per_dir.join(listed, "o_orderstatus", "left").select(
        "o_orderstatus", (F.col("files_listed") == F.col("files_read")).alias("files_match"),
        "rows", "min_key", "max_key")


def cross_database_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases with their own locations, one table each (one
    written with saveAsTable, one with the V2 createOrReplace path), joined in SQL on two
    keys."""
    root = work_dir(spark, "catalogs")
    tag = uuid.uuid4().hex[:8]
    db_a, db_b = f"tp_files_{tag}", f"tp_v2_{tag}"
    K.create_database(spark, db_a, f"{root}/{db_a}.db")
    K.create_database(spark, db_b, f"{root}/{db_b}.db")
    ev = read_events(spark, sf_dir)
    lo, hi = HOURLY_VALUE_RANGE
    hourly = (ev.filter(F.col("value").between(lo, hi))
              .groupBy(F.hour("ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n")))
    totals = ev.groupBy(F.hour("ts").alias("hour"), "event_type").agg(F.sum("value").alias("total_value"))
    K.save_table(hourly, f"{db_a}.hourly")
    K.create_or_replace(totals.withColumn("total_value", -F.col("total_value")), f"{db_b}.totals")
    # replaced by a query on itself
    K.create_or_replace(spark.table(f"{db_b}.totals").withColumn("total_value", -F.col("total_value")), f"{db_b}.totals")
    joined = spark.sql(f"""
        SELECT a.hour, a.event_type, a.n, round(b.total_value, 6) AS total_value
        FROM {db_a}.hourly a JOIN {db_b}.totals b ON a.hour = b.hour AND a.event_type = b.event_type""")
    joined.write.parquet(f"{root}/joined")
    for db in (db_a, db_b):
        K.drop_database(spark, db)
    return spark.read.parquet(f"{root}/joined")


LAYOUT_SQL = {
    "partition_totals": f"""
SELECT CAST(o_orderkey % (SELECT CAST(greatest({MIN_REPORT_FILES}, ceil(count(*) / {ROWS_PER_FILE})) AS BIGINT) FROM orders) AS INTEGER) AS file,
       count(*) AS rows, true AS was_read FROM orders GROUP BY 1
""",
    "dir_file_stats": """
SELECT o_orderstatus, true AS files_match, count(*) AS rows, min(o_orderkey) AS min_key,
       max(o_orderkey) AS max_key FROM orders GROUP BY 1
""",
    "cross_database_join": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type,
       count(*) FILTER (WHERE value BETWEEN {HOURLY_VALUE_RANGE[0]} AND {HOURLY_VALUE_RANGE[1]}) AS n,
       round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2
HAVING count(*) FILTER (WHERE value BETWEEN {HOURLY_VALUE_RANGE[0]} AND {HOURLY_VALUE_RANGE[1]}) > 0
""",
}
