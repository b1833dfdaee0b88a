"""M10 as a live alert: the stream itself reports a query that has gone quiet.

The watchdog is a stream over progress rows (what `MetricsListener` persists).  Per query it keeps the
time of its last batch and a timer `factor` trigger intervals later, which every newer batch moves.  A
timer that runs out is an alert row; so is a gap that a batch after it closes within one micro-batch, as
no timer can run out inside one.  A query is alerted once per silence.

`by_event_time` sets timers on the batch times themselves: silence is measured against the other queries'
progress (the watermark), which a replay or a late log gives the same result for.  Without it timers run
on the clock and fire while nothing at all arrives.  State and timers live in the state store, so a
restarted watchdog still knows what it waits for.  A batch older than the last one changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ALERTS = "query_name string, last_batch timestamp, alert_at timestamp"


def _time(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)


class QuietQueries(StatefulProcessor):
    """State per query: the time of its last batch, its timer, and whether this silence was reported."""

    def __init__(self, limit_ms: int, by_event_time: bool):
        self.limit_ms, self.by_event_time = limit_ms, by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "last long, timer long, reported boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, timer, reported = self.state.get() if self.state.exists() else (None, None, False)
        newest = last
        for at in sorted({r.batch_ms for r in rows}):
            if newest is not None and at <= newest:
                continue
            if self.by_event_time and newest is not None and at > newest + self.limit_ms and not reported:
                yield self._alert(key, newest, newest + self.limit_ms)
            newest, reported = at, False
        if newest == last:
            return
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = (newest if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()) + self.limit_ms + 1
        self.handle.registerTimer(timer)  # a batch at the very end of the limit is in time
        self.state.update((newest, timer, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, timer, reported = self.state.get()
        if not reported:
            self.state.update((last, timer, True))
            yield self._alert(key, last, timer - 1)

    def close(self) -> None:
        pass

    def _alert(self, key, last: int, at: int) -> Row:
        return Row(query_name=key[0], last_batch=_time(last), alert_at=_time(at))


def quiet_queries(progress: DataFrame, trigger_seconds: float, factor: float = 3.0, by_event_time: bool = True) -> DataFrame:
    """Alerts of a progress stream (columns query_name, batch_timestamp): query, last batch, when it was missed."""
    rows = progress.where("query_name IS NOT NULL AND batch_timestamp IS NOT NULL").select(
        "query_name", "batch_timestamp", F.unix_millis("batch_timestamp").alias("batch_ms"))
    if by_event_time:
        rows = rows.withWatermark("batch_timestamp", "0 seconds")
    mode = "EventTime" if by_event_time else "ProcessingTime"
    return rows.groupBy("query_name").transformWithState(QuietQueries(int(trigger_seconds * factor * 1000), by_event_time), ALERTS, "Append", mode)
