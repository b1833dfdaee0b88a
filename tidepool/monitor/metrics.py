"""Monitoring calculations over the progress table (M1 schema).

Every function takes the progress DataFrame and returns a DataFrame; windows are
partitioned by query, and the progress table has one row per micro-batch, so a window
partition is one query's batch history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.scalar import label_or_id, real_watermark


def labelled(progress: DataFrame) -> DataFrame:
    """every row gets a query label: its name, or `unnamed-<first 8 of id>`."""
    return progress.withColumn("query_name", label_or_id("query_name", "query_id"))


def totals(progress: DataFrame) -> DataFrame:
    """M4: batches, input rows, last batch duration and rows dropped per query."""
    return progress.groupBy("query_name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("num_input_rows"), F.lit(0)).alias("input_rows"),
        F.max_by("trigger_ms", "batch_id").alias("last_batch_ms"),
        F.coalesce(F.sum("rows_dropped_by_watermark"), F.lit(0)).alias("dropped_rows"))


def backlog(progress: DataFrame, last_n: int = 5, sustained_minutes: int = 10) -> DataFrame:
    """M5 (W2): input rate above processing rate over the last `last_n` batches, and
    whether the longest unbroken run of such batches lasted `sustained_minutes` or more."""
    w_desc = Window.partitionBy("query_name").orderBy(F.desc("batch_id"))
    recent = (progress.withColumn("_rn", F.row_number().over(w_desc)).filter(F.col("_rn") <= last_n)
              .groupBy("query_name").agg(F.avg("input_rows_per_sec").alias("avg_input_rate"),
                                         F.avg("processed_rows_per_sec").alias("avg_processed_rate")))
    behind = F.coalesce(F.col("input_rows_per_sec") > F.col("processed_rows_per_sec"), F.lit(False))
    w = Window.partitionBy("query_name").orderBy("batch_id")
    runs = (progress.withColumn("_behind", behind)
            .withColumn("_run", F.sum((~F.col("_behind")).cast("int")).over(w))
            .filter("_behind")
            .groupBy("query_name", "_run").agg(
                ((F.unix_timestamp(F.max("batch_timestamp")) - F.unix_timestamp(F.min("batch_timestamp"))) / 60.0)
                .alias("_minutes"))
            .groupBy("query_name").agg(F.max("_minutes").alias("longest_backlog_minutes")))
    return (recent.join(runs, "query_name", "left")
            .select("query_name", "avg_input_rate", "avg_processed_rate",
                    F.coalesce(F.col("avg_input_rate") > F.col("avg_processed_rate"), F.lit(False)).alias("backlog"),
                    F.coalesce("longest_backlog_minutes", F.lit(0.0)).alias("longest_backlog_minutes"),
                    F.coalesce(F.col("longest_backlog_minutes") >= sustained_minutes, F.lit(False))
                    .alias("sustained_backlog")))


def rate_series(progress: DataFrame) -> DataFrame:
    """Input and processed rates in long form, one row per batch and rate."""
    long = progress.unpivot(["query_name", "batch_id", "batch_timestamp"],
                            ["input_rows_per_sec", "processed_rows_per_sec"], "rate", "rows_per_sec")
    return long.withColumn("rate", F.regexp_replace("rate", "_rows_per_sec$", ""))


def watermark_series(progress: DataFrame) -> DataFrame:
    """M7: watermark (NULL while it is still the epoch placeholder), state and drops over time."""
    return progress.select("query_name", "batch_id", "batch_timestamp",
                           real_watermark("watermark").alias("watermark"), "state_rows",
                           "duplicates_dropped", "rows_dropped_by_watermark")


def late_drop_ratio(progress: DataFrame, window_seconds: int = 1800, page_ratio: float = 0.01) -> DataFrame:
    """M8 (W1): rows dropped / rows in over the trailing 30 minutes, per query and batch;
    page above 1 %; ticket when any row was dropped in the same UTC day.  NULL ratio when
    no rows came in."""
    t = F.unix_timestamp("batch_timestamp")
    w = Window.partitionBy("query_name").orderBy(t).rangeBetween(-window_seconds, 0)
    day = Window.partitionBy("query_name", F.to_date("batch_timestamp"))
    dropped = F.coalesce(F.col("rows_dropped_by_watermark"), F.lit(0))
    out = (progress
           .withColumn("dropped_30m", F.sum(dropped).over(w))
           .withColumn("input_30m", F.sum(F.coalesce("num_input_rows", F.lit(0))).over(w))
           .withColumn("drop_ratio", F.try_divide(F.col("dropped_30m"), F.nullif(F.col("input_30m"), F.lit(0))))
           .withColumn("page", F.coalesce(F.col("drop_ratio") > page_ratio, F.lit(False)))
           .withColumn("ticket", F.sum(dropped).over(day) > 0))
    return out.select("query_name", "batch_id", "batch_timestamp", "dropped_30m", "input_30m", "drop_ratio",
                      "page", "ticket")


def freshness(progress: DataFrame, now, trigger_seconds: float, factor: float = 3.0) -> DataFrame:
    """A query is stale when its last batch is older than `factor` trigger intervals at `now`
    (a time or a column)."""
    last = progress.groupBy("query_name").agg(F.max("batch_timestamp").alias("last_batch"))
    at = now if isinstance(now, Column) else F.lit(now)
    age = F.unix_timestamp(at.cast("timestamp")) - F.unix_timestamp("last_batch")
    return last.select("query_name", "last_batch", age.alias("age_seconds"),
                       (age > factor * trigger_seconds).alias("stale"))


def lag_alert(p99_seconds: DataFrame, delay_seconds: float, share: float = 0.8) -> DataFrame:
    """M9: ticket when the p99 event-time lag exceeds `share` of the watermark delay."""
    return p99_seconds.withColumn("ticket", F.col("p99") > share * delay_seconds)
