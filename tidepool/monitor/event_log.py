"""Task metrics from Spark's event log, read as a table.

An application with `spark.eventLog.enabled` writes one JSON line an event.  The lines of ended tasks
become one row a task, and per stage the smallest, median and largest task.  No web page or REST
interface is involved; a log may be read while it grows, and rolled logs are read as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_END = """
`Event` string, `Stage ID` long, `Stage Attempt ID` long, `Task End Reason` struct<`Reason`: string>,
`Task Info` struct<`Task ID`: long, `Index`: long, `Attempt`: long, `Partition ID`: long, `Executor ID`: string, `Launch Time`: long, `Finish Time`: long>,
`Task Metrics` struct<`Executor Run Time`: long, `Executor CPU Time`: long, `JVM GC Time`: long, `Disk Bytes Spilled`: long, `Peak Execution Memory`: long,
  `Input Metrics`: struct<`Bytes Read`: long, `Records Read`: long>, `Output Metrics`: struct<`Bytes Written`: long, `Records Written`: long>,
  `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long, `Total Records Read`: long>,
  `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long, `Shuffle Records Written`: long>>
"""

MEASURES = ("run_ms", "rows_read", "bytes_read", "shuffle_rows_read", "shuffle_bytes_read", "shuffle_rows_written", "shuffle_bytes_written", "rows_written")


def task_rows(spark: SparkSession, log: str) -> DataFrame:
    """One row for each task attempt that ended: where it ran, whether it succeeded, rows, bytes and time."""
    e = spark.read.option("recursiveFileLookup", "true").text(log).select(F.from_json("value", TASK_END).alias("e")).where("e.Event = 'SparkListenerTaskEnd'")
    info, m = F.col("e")["Task Info"], F.col("e")["Task Metrics"]
    read, wrote = m["Shuffle Read Metrics"], m["Shuffle Write Metrics"]
    return e.select(
        F.col("e")["Stage ID"].alias("stage"), F.col("e")["Stage Attempt ID"].alias("stage_attempt"), info["Task ID"].alias("task"),
        info["Partition ID"].alias("partition"), info["Attempt"].alias("attempt"), info["Executor ID"].alias("executor"),
        (F.col("e")["Task End Reason"]["Reason"] == "Success").alias("ok"), F.timestamp_millis(info["Launch Time"]).alias("launched"),
        m["Executor Run Time"].alias("run_ms"), m["Executor CPU Time"].alias("cpu_ns"), m["JVM GC Time"].alias("gc_ms"), m["Disk Bytes Spilled"].alias("spilled_bytes"),
        m["Peak Execution Memory"].alias("peak_bytes"), m["Input Metrics"]["Records Read"].alias("rows_read"), m["Input Metrics"]["Bytes Read"].alias("bytes_read"),
        m["Output Metrics"]["Records Written"].alias("rows_written"), read["Total Records Read"].alias("shuffle_rows_read"),
        (read["Remote Bytes Read"] + read["Local Bytes Read"]).alias("shuffle_bytes_read"),
        wrote["Shuffle Records Written"].alias("shuffle_rows_written"), wrote["Shuffle Bytes Written"].alias("shuffle_bytes_written"))


def stage_balance(tasks: DataFrame, measure: str = "rows_read") -> DataFrame:
    """A16 over tasks: per stage the successful tasks, the sum of a measure, and its smallest, median and
    largest task, with largest / median (NULL where the median is 0)."""
    if measure not in MEASURES:
        raise ValueError(f"{measure!r} is none of {', '.join(MEASURES)}")
    c = F.coalesce(F.col(measure), F.lit(0))
    return tasks.where("ok").groupBy("stage", "stage_attempt").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum(c).alias("total"), F.min(c).alias("smallest"), F.median(c).alias("median"), F.max(c).alias("largest"),
        F.try_divide(F.max(c), F.median(c)).alias("largest_over_median"))
