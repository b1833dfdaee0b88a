"""Stream progress as rows, and the metrics that streams observe on the way.

`progress_rows` turns progress records (from `recentProgress`, or gathered by a listener)
into the 15-column metrics table; `MetricsListener` logs each event and appends its row to a
Parquet folder while the stream runs; `RunRecords` gathers all records of one run.  Progress records are
per micro-batch metadata (a few per minute per query), not data rows.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("tidepool.monitor")

PROGRESS_SCHEMA = T.StructType([
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("query_name", T.StringType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch_timestamp", T.TimestampType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_sec", T.DoubleType()),
    T.StructField("processed_rows_per_sec", T.DoubleType()),
    T.StructField("trigger_ms", T.LongType()),
    T.StructField("add_batch_ms", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("rows_dropped_by_watermark", T.LongType()),
    T.StructField("duplicates_dropped", T.LongType()),
])


def _ts(s: str | None):
    if not s:
        return None
    return dt.datetime.fromisoformat(s.replace("Z", "+00:00")).astimezone(dt.timezone.utc)


def _num(x):
    if x is None:
        return None
    try:
        f = float(x)
    except (TypeError, ValueError):
        return None
    return None if f != f else f  # NaN -> None (F12)


def progress_row(p: dict, logged_at: dt.datetime | None = None) -> tuple:
    """One metrics row from one progress record (a dict in the progress JSON layout)."""
    ops = p.get("stateOperators") or []
    dur = p.get("durationMs") or {}
    return (
        logged_at or dt.datetime.now(dt.timezone.utc),
        p.get("name"), p.get("id"), p.get("runId"), p.get("batchId"), _ts(p.get("timestamp")),
        p.get("numInputRows"), _num(p.get("inputRowsPerSecond")), _num(p.get("processedRowsPerSecond")),
        dur.get("triggerExecution"), dur.get("addBatch"), (p.get("eventTime") or {}).get("watermark"),
        sum(int(o.get("numRowsTotal") or 0) for o in ops) if ops else None,
        sum(int(o.get("numRowsDroppedByWatermark") or 0) for o in ops) if ops else None,
        sum(int((o.get("customMetrics") or {}).get("numDroppedDuplicateRows") or 0) for o in ops) if ops else None,
    )


OBSERVED_SCHEMA = T.StructType([
    T.StructField("query_name", T.StringType()), T.StructField("query_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()), T.StructField("observed", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def observed_rows(p: dict) -> list[tuple]:
    """One row for each observed metric (`DataFrame.observe`) of one progress record."""
    return [(p.get("name"), p.get("id"), p.get("runId"), p.get("batchId"), name, metric, _num(value))
            for name, metrics in (p.get("observedMetrics") or {}).items() for metric, value in metrics.items()]


def metrics_folders(sink_dir: str) -> tuple[str, str]:
    """Where a listener keeps the progress rows and the observed metrics."""
    return sink_dir, f"{sink_dir.rstrip('/')}_observed"


def progress_rows(spark: SparkSession, records: list[dict]) -> DataFrame:
    """M1: the metrics table from a list of progress records."""
    return spark.createDataFrame([progress_row(p) for p in records], PROGRESS_SCHEMA)


def progress_dict(p) -> dict:
    """A progress record as a plain dict of JSON values."""
    raw = getattr(p, "json", None)
    return json.loads(raw) if isinstance(raw, str) else dict(p)


class MetricsListener(StreamingQueryListener):
    """M2 + M3: log started / progress / idle / terminated lines; one row per batch, persisted
    while the stream runs.

    Callbacks arrive on the listener thread; they only log and queue.  A writer thread appends what
    is queued to the sink folder at once, so the queue holds the rows of the write under way and a
    crash loses no more than these.  Without a session the rows wait for `flush`.  A callback never
    raises (a failing listener must not disturb the queries).
    """

    def __init__(self, sink_dir: str | None = None, spark: SparkSession | None = None):
        self.sink_dir = sink_dir
        self.spark = spark if sink_dir else None
        self.seen = 0
        self._rows: list[tuple] = []
        self._observed: list[tuple] = []
        self._more = threading.Condition()
        self._write = threading.Lock()
        self._closed = False
        self._writer: threading.Thread | None = None

    def onQueryStarted(self, event):
        log.info("started %s (%s)", event.name, event.id)

    def onQueryProgress(self, event):
        try:
            d = progress_dict(event.progress)
            if d.get("numInputRows", 0) == 0:
                log.info("idle %s batch %s", d.get("name"), d.get("batchId"))
            else:
                log.info("progress %s batch %s rows %s", d.get("name"), d.get("batchId"), d.get("numInputRows"))
            self.record(d)
        except Exception:  # noqa: BLE001
            log.exception("listener progress callback failed")

    def onQueryIdle(self, event):
        log.info("idle %s", event.id)

    def onQueryTerminated(self, event):
        log.info("terminated %s exception=%s", event.id, event.exception)

    def record(self, progress: dict) -> None:
        with self._more:
            self._rows.append(progress_row(progress))
            self._observed += observed_rows(progress)
            self.seen += 1
            if self.spark is not None and self._writer is None:
                self._writer = threading.Thread(target=self._persist, name="metrics-writer", daemon=True)
                self._writer.start()
            self._more.notify_all()

    def _persist(self) -> None:
        while True:
            with self._more:
                self._more.wait_for(lambda: self._rows or self._closed)
                if self._closed and not self._rows:
                    return
            try:
                self.flush(self.spark)
            except Exception:  # noqa: BLE001 - the rows are queued again; wait for the next batch
                log.exception("writing metrics failed")
                with self._more:
                    if self._closed:
                        return
                    self._more.wait(timeout=5)

    def settle(self, min_rows: int = 1, quiet_seconds: float = 0.5, timeout: float = 15.0) -> None:
        """Wait until at least `min_rows` progress events came and none for `quiet_seconds`
        (callbacks are delivered asynchronously, after the batch that produced them)."""
        end = time.monotonic() + timeout
        with self._more:
            while time.monotonic() < end:
                before = self.seen
                if not self._more.wait(timeout=quiet_seconds) and self.seen == before >= min_rows:
                    return

    def rows(self) -> list[tuple]:
        with self._more:
            return list(self._rows)

    def flush(self, spark: SparkSession) -> int:
        """Append the queued rows to the sink folder (one writer at a time); returns rows written."""
        with self._write:
            with self._more:
                rows, self._rows, observed, self._observed = self._rows, [], self._observed, []
            if rows and self.sink_dir:
                to, to_observed = metrics_folders(self.sink_dir)
                try:
                    if observed:
                        spark.createDataFrame(observed, OBSERVED_SCHEMA).coalesce(1).write.mode("append").parquet(to_observed)
                        observed = []
                    spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(to)
                except Exception:
                    with self._more:
                        self._rows, self._observed = rows + self._rows, observed + self._observed
                    raise
            return len(rows)

    def close(self) -> None:
        """Write what is left and end the writer thread."""
        with self._more:
            self._closed = True
            self._more.notify_all()
        if self._writer is not None:
            self._writer.join()


class RunRecords(MetricsListener):
    """The progress of every micro-batch of the runs of one query name, for the time of a `with`."""

    def __init__(self, spark: SparkSession, name: str, metrics_dir: str | None = None):
        super().__init__(metrics_dir, spark)
        self.session, self.name = spark, name
        self.batches: list[dict] = []
        self.ended: set[str] = set()

    def record(self, progress: dict) -> None:
        if progress.get("name") == self.name:
            with self._more:
                self.batches.append(progress)
            if self.sink_dir:
                super().record(progress)
            with self._more:
                self._more.notify_all()

    def onQueryTerminated(self, event):
        super().onQueryTerminated(event)
        with self._more:
            self.ended.add(str(event.runId))
            self._more.notify_all()

    def __enter__(self):
        attach(self.session, self)
        return self

    def __exit__(self, *exc):
        with self._more:  # the end of a run is reported after all its batches
            if exc[0] is None:
                self._more.wait_for(lambda: self.ended, timeout=60)
        detach(self.session, self)
        self.close()

    def of(self, run_id: str, last) -> list[dict]:
        """The batches of one run; an error if the last one never arrived.  (What Spark reports last of
        a run that found nothing new is no batch, and is not sent to listeners.)"""
        found = [p for p in self.batches if p.get("runId") == run_id]
        end = progress_dict(last) if last is not None else {}
        if end.get("numInputRows") and (not found or found[-1].get("batchId") != end.get("batchId")):
            raise RuntimeError(f"progress of stream {self.name} is incomplete")
        return found


def attach(spark: SparkSession, listener: StreamingQueryListener) -> None:
    """Add a listener once (adding the same object twice would double every row)."""
    attached = getattr(spark, "_tidepool_listeners", set())
    if id(listener) not in attached:
        spark.streams.addListener(listener)
        attached.add(id(listener))
        spark._tidepool_listeners = attached


def detach(spark: SparkSession, listener: StreamingQueryListener) -> None:
    attached = getattr(spark, "_tidepool_listeners", set())
    if id(listener) in attached:
        spark.streams.removeListener(listener)
        attached.discard(id(listener))
