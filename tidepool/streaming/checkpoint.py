"""A stream's checkpoint, state and state changes read back as rows.

The checkpoint logs (`offsets/`, `commits/`, `sources/0/`, `metadata`) are small text
files: a version line, then JSON.  They are read with the text source, one row per line,
the batch id taken from the file name (`9.compact` included; `.crc` sidecars are hidden
files and never listed).  The state held by stateful operators is read with the built-in
`statestore` source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOGS = ("offsets", "commits", "sources/0")


def read_log(spark: SparkSession, checkpoint_dir: str, log: str) -> DataFrame:
    """One row per line of one log: log, batch_id, line number, text."""
    t = spark.read.option("wholetext", "false").text(f"{checkpoint_dir}/{log}")
    name = F.col("_metadata.file_name")
    batch = F.regexp_extract(name, r"^(\d+)", 1).cast("long")
    w_line = F.monotonically_increasing_id()
    return t.select(F.lit(log).alias("log"), name.alias("file"), batch.alias("batch_id"),
                    (name.endswith(".compact")).alias("compacted"), w_line.alias("_pos"),
                    F.col("value").alias("line"))


def checkpoint_rows(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """All logs, with the offsets' batch watermark and timestamp parsed out."""
    parts = [read_log(spark, checkpoint_dir, log) for log in LOGS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = F.from_json("line", "batchWatermarkMs long, batchTimestampMs long")
    return (out.withColumn("_m", F.when(F.col("line").startswith("{"), meta))
            .select("log", "file", "batch_id", "compacted", "line",
                    F.col("_m.batchWatermarkMs").alias("batch_watermark_ms"),
                    F.col("_m.batchTimestampMs").alias("batch_timestamp_ms")))


def state_rows(spark: SparkSession, checkpoint_dir: str, operator_id: int = 0) -> DataFrame:
    """Rows still held in a stateful operator's state store."""
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint_dir)


def state_changes(spark: SparkSession, checkpoint_dir: str, start_batch: int = 0, end_batch: int | None = None,
                  operator_id: int = 0) -> DataFrame:
    """The change feed of a stateful operator: one row for each key that a batch put (`update`, with
    the new value) or removed (`delete`), in batches `start_batch` to `end_batch` (the last committed one)."""
    feed = spark.read.format("statestore").option("operatorId", operator_id).option("readChangeFeed", True).option("changeStartBatchId", start_batch)
    if end_batch is not None:
        feed = feed.option("changeEndBatchId", end_batch)
    return feed.load(checkpoint_dir)


def state_lifetimes(changes: DataFrame) -> DataFrame:
    """Per key of a change feed: the batch that first put it, the batches that put it, and the one that
    removed it last (NULL while it is held)."""
    put, gone = F.col("change_type") == "update", F.col("change_type") == "delete"
    per = changes.groupBy("key").agg(F.min(F.when(put, F.col("batch_id"))).alias("opened_in"), F.count_if(put).alias("updates"),
                                     F.max(F.when(put, F.col("batch_id"))).alias("_last"), F.max(F.when(gone, F.col("batch_id"))).alias("_gone"))
    return per.select("key", "opened_in", "updates", F.when(F.col("_gone") >= F.col("_last"), F.col("_gone")).alias("closed_in"))
