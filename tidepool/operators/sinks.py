"""Batch sinks.

Every write goes through Spark's commit protocol: tasks write under `_temporary`, the job
commit moves files into place and leaves `_SUCCESS`, so a reader never sees a half
written folder and a retried task never leaves a duplicate file behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  partition_by: list[str] | None = None, max_records_per_file: int | None = None) -> None:
    """K4 (+K2, K18): Parquet folder, one file per task unless `files` is given."""
    out = df.repartition(files) if files else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: JSON lines."""
    df.write.mode(mode).json(path)


def run_noop(df: DataFrame) -> None:
    """K6: execute the whole plan and write nothing (for timing)."""
    df.write.format("noop").mode("overwrite").save()


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """K9: read a folder whose files were written with wider and narrower schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)
