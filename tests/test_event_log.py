"""The event log of another application, read as a table."""

import subprocess
import sys

import pytest

from conftest import SF001
from tidepool.monitor import event_log as E

APP = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
     .config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false").config("spark.sql.adaptive.enabled", "false")
     .config("spark.sql.shuffle.partitions", "5").getOrCreate())
li = s.read.parquet(sys.argv[2] + "/lineitem.parquet")
li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).write.format("noop").mode("overwrite").save()
s.stop()
"""


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("events")
    subprocess.run([sys.executable, "-c", APP, f"file://{at}", SF001], check=True, timeout=120, capture_output=True)
    return f"file://{at}"


def test_rows_per_stage_are_the_tables_rows(spark, log):
    tasks = E.task_rows(spark, log).persist()
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    rows, orders = li.count(), li.select("l_orderkey").distinct().count()
    scan = E.stage_balance(tasks).where("total > 0").collect()
    assert [r.total for r in scan] == [rows] and scan[0].smallest <= scan[0].median <= scan[0].largest
    reduced = E.stage_balance(tasks, "shuffle_rows_read").where("total > 0").collect()
    assert [(r.tasks, r.total) for r in reduced] == [(5, E.stage_balance(tasks, "shuffle_rows_written").where("total > 0").first().total)]
    assert reduced[0].total >= orders and reduced[0].largest_over_median < 2
    assert tasks.where("NOT ok OR run_ms IS NULL OR launched IS NULL OR executor IS NULL").count() == 0
    assert tasks.select("task").distinct().count() == tasks.count()
    tasks.unpersist()


def test_other_lines_and_measures(spark, log, scratch):
    lines = spark.createDataFrame([("not json",), ('{"Event":"SparkListenerTaskEnd","Stage ID":3}',), ('{"Event":"Other"}',)], "value string")
    lines.write.text(f"{scratch}/log")
    got = E.task_rows(spark, f"{scratch}/log").collect()
    assert [(r.stage, r.ok, r.rows_read) for r in got] == [(3, None, None)]
    assert E.stage_balance(E.task_rows(spark, f"{scratch}/log")).collect() == []
    with pytest.raises(ValueError):
        E.stage_balance(E.task_rows(spark, log), "nothing")
