"""The freshness watchdog: gaps, timers, restarts, late and repeated batches, the clock."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidepool.monitor.watchdog import quiet_queries
from tidepool.streaming import layers as L

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
COLUMNS = "query_name string, batch_timestamp timestamp, batch_ms string, last long"


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.session = L.stream_session(spark, 2)

    def put(self, *rows):
        at = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
        df = self.spark.createDataFrame([(q, at(m), "clash", 1) for q, m in rows], COLUMNS)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/progress")

    def drain(self):
        src = L.layer_source(self.session, f"{self.root}/progress", self.spark.createDataFrame([], COLUMNS).schema)
        L.drain(quiet_queries(src, 600), f"{self.root}/alerts", f"{self.root}/ck", "watchdog_test")
        minutes = lambda c: ((F.unix_timestamp(c) - int(T0.timestamp())) / 60).cast("int")
        return sorted(map(tuple, self.spark.read.parquet(f"{self.root}/alerts").select("query_name", minutes("last_batch"), minutes("alert_at")).collect()))


@pytest.fixture()
def feed(spark, scratch):
    return Feed(spark, scratch)


def test_gap_within_a_batch_and_a_query_that_stays_quiet(feed):
    feed.put(("a", 0), ("a", 10), ("a", 50), ("b", 0), ("c", 20), ("c", 50), (None, 0), ("d", None))
    assert feed.drain() == [("a", 10, 40), ("b", 0, 30)]  # 30 minutes is in time (c), 40 is not


def test_restart_keeps_timers_and_reports_once(feed):
    feed.put(("a", 0), ("b", 0), ("b", 20))
    assert feed.drain() == []
    feed.put(("b", 40))  # the watermark passes a's limit in another run of the query
    assert feed.drain() == [("a", 0, 30)]
    feed.put(("b", 60), ("b", 80))
    assert feed.drain() == [("a", 0, 30)]  # one alert a silence
    feed.put(("a", 85), ("b", 100))
    assert feed.drain() == [("a", 0, 30)]  # its end is no second alert
    feed.put(("b", 120))
    assert feed.drain() == [("a", 0, 30), ("a", 85, 115)]  # the next silence is


def test_late_and_repeated_batches_change_nothing(feed):
    feed.put(("a", 0), ("a", 20), ("b", 20))
    assert feed.drain() == []
    feed.put(("a", 10), ("a", 20), ("b", 50))
    assert feed.drain() == []
    feed.put(("b", 51))
    assert feed.drain() == [("a", 20, 50)]


def test_empty_stream(feed):
    feed.put()
    assert feed.drain() == []


def test_on_the_clock(feed, spark):
    """Nothing else arrives: the timer runs out by processing time."""
    feed.put(("a", 0))
    src = L.layer_source(feed.session, f"{feed.root}/progress", spark.createDataFrame([], COLUMNS).schema)
    q = (quiet_queries(src, 1, by_event_time=False).writeStream.format("parquet").option("path", f"{feed.root}/live")
         .option("checkpointLocation", f"{feed.root}/live_ck").trigger(processingTime="500 milliseconds").start())
    try:
        end = time.time() + 60
        found = 0
        while not found and time.time() < end:
            time.sleep(0.5)
            try:
                found = spark.read.schema("query_name string, last_batch timestamp, alert_at timestamp").parquet(f"{feed.root}/live").count()
            except Exception:  # noqa: BLE001 - the folder is not there yet
                continue
        assert found == 1
    finally:
        q.stop()
