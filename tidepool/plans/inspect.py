"""Plan inspection and measurement helpers.

These are test and bench helpers: they look at what Spark planned (`explain` text) or time
a query through the `noop` sink; none of them reads the Spark UI.
"""

from __future__ import annotations

import contextlib
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan that SQL `EXPLAIN` reports for a DataFrame ("simple": without a mode).  SQL cannot
    explain a stream, so there it is the text of the DataFrame's own `explain`."""
    spark = df.sparkSession
    if df.isStreaming:
        return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    view = f"explained_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        keyword = "" if mode == "simple" else mode.upper()
        return spark.sql(f"EXPLAIN {keyword} SELECT * FROM {view}").first()[0]
    finally:
        spark.catalog.dropTempView(view)


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the plan (broadcasts not counted)."""
    return len(re.findall(r"^\(\d+\) Exchange", plan_text(df), flags=re.M))


def shuffles(df: DataFrame) -> bool:
    """Does this query move data between tasks?"""
    return exchanges(df) > 0


def join_strategies(df: DataFrame) -> list[str]:
    """The join operators Spark chose (e.g. BroadcastHashJoin, SortMergeJoin)."""
    return re.findall(r"^\(\d+\) (\w*Join)", plan_text(df), flags=re.M)


def pushed_filters(df: DataFrame) -> list[str]:
    """Filters handed to the file scans."""
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    """Columns each file scan reads (column pruning)."""
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df))


def schema_string(df: DataFrame) -> str:
    """The schema in one line."""
    return df.schema.simpleString()


@contextlib.contextmanager
def job_description(spark: SparkSession, text: str) -> Iterator[None]:
    """Name the jobs started inside the block; reset afterwards (the setting is sticky)."""
    sc = spark.sparkContext
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(None)


@contextlib.contextmanager
def job_tag(spark: SparkSession, tag: str) -> Iterator[str]:
    """Tag the jobs started inside the block so they can be cancelled together
    (`cancel_tagged`); the tag is removed afterwards."""
    sc = spark.sparkContext
    sc.addJobTag(tag)
    try:
        yield tag
    finally:
        sc.removeJobTag(tag)


def cancel_tagged(spark: SparkSession, tag: str) -> None:
    """Cancel every running job carrying `tag` (from any thread)."""
    spark.sparkContext.cancelJobsWithTag(tag)


def timed(df: DataFrame) -> float:
    """Seconds to run the whole plan into the noop sink (K6)."""
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t


def partition_sweep(spark: SparkSession, build: Callable[[], DataFrame], counts: Sequence[int] = (1, 8, 64, 512, 4096)
                    ) -> DataFrame:
    """The same query at several shuffle partition counts (AQE coalescing off so the
    count is what runs).  The DataFrame is rebuilt after every setting change."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    rows = []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in counts:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            rows.append((int(n), timed(build())))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    return spark.createDataFrame(rows, "partitions int, seconds double")


def aqe_compare(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The same query with adaptive execution off, then on (rebuilt each time)."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    rows = []
    try:
        for on in (False, True):
            spark.conf.set("spark.sql.adaptive.enabled", str(on).lower())
            rows.append((on, timed(build())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    return spark.createDataFrame(rows, "aqe boolean, seconds double")
