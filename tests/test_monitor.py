"""Monitoring calculations on a small hand-made progress table, and the listener."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidepool.monitor import metrics as M
from tidepool.monitor.progress import PROGRESS_SCHEMA, MetricsListener, attach, detach, progress_row
from tidepool.streaming.replay import READINGS_SCHEMA

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _row(q, b, ts, n, in_rate, proc_rate, wm="1970-01-01T00:00:00.000Z", dropped=0, state=0, dups=0):
    return (ts, q, f"id-{q}", f"run-{q}", b, ts, n, in_rate, proc_rate, 1000, 800, wm, state, dropped, dups)


@pytest.fixture(scope="module")
def metrics(spark):
    rows = []
    # bronze: 10 s trigger, 13 batches; batches 5-10 (six) take in more than they process.
    for b in range(13):
        behind = 5 <= b <= 10
        rows.append(_row("bronze", b, T0 + dt.timedelta(seconds=10 * b), 150,
                         None if b == 0 else (50.0 if behind else 15.0), None if b == 0 else (30.0 if behind else 40.0)))
    # silver: 2 min trigger; six batches in a row behind -> a backlog lasting 10 minutes.
    for b in range(12):
        behind = 3 <= b <= 8
        rows.append(_row("silver", b, T0 + dt.timedelta(minutes=2 * b), 150, 20.0 if behind else 10.0,
                         10.0 if behind else 30.0, state=100 + b, dups=1 if b == 4 else 0))
    # gold: 10 s trigger, one 1.5 % drop spell at batch 3, watermark set from batch 2 on,
    # and its last batch 4 triggers before "now".
    for b in range(15):
        wm = "1970-01-01T00:00:00.000Z" if b < 2 else f"2024-01-01T11:{b:02d}:00.000Z"
        rows.append(_row("gold", b, T0 + dt.timedelta(seconds=10 * b), 200, 20.0, 60.0, wm=wm,
                         dropped=12 if b == 3 else 0, state=30))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


NOW = T0 + dt.timedelta(seconds=10 * 14 + 40)  # gold's last batch + 4 triggers


def test_totals(metrics):
    t = {r["query_name"]: r for r in M.totals(metrics).collect()}
    assert t["bronze"]["batches"] == 13 and t["bronze"]["input_rows"] == 13 * 150
    assert t["gold"]["dropped_rows"] == 12 and t["gold"]["last_batch_ms"] == 1000


def test_backlog(metrics):
    b = {r["query_name"]: r for r in M.backlog(metrics).collect()}
    assert b["bronze"]["backlog"] is True  # last five batches include 8, 9, 10 behind
    assert b["bronze"]["sustained_backlog"] is False  # 50 s only
    assert b["silver"]["sustained_backlog"] is True and b["silver"]["longest_backlog_minutes"] == 10.0
    assert b["gold"]["backlog"] is False


def test_rate_series_long_form(metrics):
    r = M.rate_series(metrics)
    assert r.count() == 2 * metrics.count()
    assert {x[0] for x in r.select("rate").distinct().collect()} == {"input", "processed"}
    assert r.filter(F.col("rows_per_sec").isNull()).count() == 2  # bronze batch 0 has no rates


def test_watermark_epoch_is_null(metrics):
    w = M.watermark_series(metrics).filter("query_name = 'gold'")
    assert w.filter(F.col("watermark").isNull()).count() == 2


def test_late_drop_ratio_pages(metrics):
    d = M.late_drop_ratio(metrics).filter("query_name = 'gold'")
    assert d.filter("page").count() > 0
    first = d.filter("batch_id = 3").first()
    assert abs(first["drop_ratio"] - 12 / 800) < 1e-12  # 1.5 %: 4 batches x 200 rows in the window
    assert d.filter("ticket").count() == 15
    assert M.late_drop_ratio(metrics).filter("query_name = 'bronze' AND page").count() == 0


def test_freshness(metrics):
    f = {r["query_name"]: r for r in M.freshness(metrics, NOW, trigger_seconds=10).collect()}
    assert f["gold"]["stale"] is True and f["gold"]["age_seconds"] == 40
    assert f["silver"]["stale"] is False  # its last batch is after "now"


def test_progress_row_nan_rates_become_null():
    r = progress_row({"name": "q", "id": "i", "runId": "r", "batchId": 0, "timestamp": "2024-01-01T00:00:00.000Z",
                      "numInputRows": 0, "inputRowsPerSecond": float("nan"), "processedRowsPerSecond": 0.0,
                      "durationMs": {"triggerExecution": 5}})
    assert r[7] is None and r[8] == 0.0 and r[9] == 5


def test_listener_persists_rows(spark, scratch, caplog):
    import logging

    caplog.set_level(logging.INFO, logger="tidepool.monitor")
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    with open(f"{landing}/a.json", "w") as f:
        f.write('{"event_id": 1, "event_time": "2024-01-01T00:00:00", "event_type": "x", "value": 1.0}\n')
    listener = MetricsListener(sink_dir=f"{scratch}/metrics", spark=spark)
    attach(spark, listener)
    attach(spark, listener)  # a second add is ignored
    try:
        q = (spark.readStream.schema(READINGS_SCHEMA).json(landing).writeStream.format("parquet")
             .option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
             .queryName("listened").trigger(availableNow=True).start())
        q.awaitTermination()
        listener.settle()  # callbacks arrive asynchronously
    finally:
        detach(spark, listener)
    listener.close()  # rows were written while the query ran
    assert listener.rows() == []
    m = spark.read.parquet(f"{scratch}/metrics")
    assert m.filter("query_name = 'listened'").agg(F.sum("num_input_rows")).first()[0] == 1
    logged = " ".join(r.getMessage() for r in caplog.records)
    assert "started listened" in logged and "progress listened" in logged
