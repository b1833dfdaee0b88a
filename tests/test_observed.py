"""Metrics that silver observes on its way: per batch in the progress, persisted by the listener, equal to a batch twin."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.monitor import progress as PR
from tidepool.streaming import layers as L
from tidepool.streaming.replay import READINGS_SCHEMA

SCHEMA = READINGS_SCHEMA


def reading(i, time="2024-01-01T00:00:00.000000", value=1.0, props='{"k": 1}', delivered="2024-01-01T00:20:00.000000"):
    return (i, time, 7, "click", value, props, delivered)


BATCHES = [
    [reading(1), reading(1), reading(2, time="at noon"), reading(3, value=None)],
    [reading(None), reading(4, props="{}"), reading(5, props=None), reading(6, time=None), reading(7, delivered="2024-01-01T00:01:00.000000")],
    [],
]
WANT = {"rows": 9, "bad_time": 1, "bad_props": 1, "no_value": 1, "incomplete": 3, "lag_seconds": 6 * 1200 + 60, "overdue": 6}


def run(spark, scratch):
    session = L.stream_session(spark, 2)
    records = []
    for n, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{scratch}/in")
        silver = L.silver(L.bronze(session, f"{scratch}/in"))
        records += L.drain(silver, f"{scratch}/out", f"{scratch}/ck", f"silver_{n}", metrics_dir=f"{scratch}/metrics")
    return records


def test_sums_over_batches_equal_the_batch_twin(spark, scratch):
    records = run(spark, scratch)
    _, kept = PR.metrics_folders(f"{scratch}/metrics")
    rows = spark.read.parquet(kept)
    got = {r.metric: r.total for r in rows.where(F.col("observed") == L.CHECKS).groupBy("metric").agg(F.sum("value").alias("total")).collect()}
    spec = L.LayerSpec()
    twin = spark.read.schema(SCHEMA).json(f"{scratch}/in").agg(*[c.alias(n) for n, c in spec.checks.items()]).first().asDict()
    assert got == twin == WANT
    told = [r for p in records for r in PR.observed_rows(p)]
    assert sorted(map(tuple, rows.collect())) == sorted(told)  # what the progress told is what is kept, batch by batch
    assert len({(r[0], r[3]) for r in told}) >= 2
    assert spark.read.parquet(f"{scratch}/out").count() == 5  # the checks drop nothing: 1, 3, 4, 5, 7


def test_checks_of_another_spec(spark, scratch):
    spec = L.LayerSpec(checks={"clicks": F.count_if(F.col("event_type") == "click")})
    spark.createDataFrame([reading(i) for i in range(4)], SCHEMA).write.json(f"{scratch}/in")
    session = L.stream_session(spark, 2)
    records = L.drain(L.silver(L.bronze(session, f"{scratch}/in"), spec), f"{scratch}/out", f"{scratch}/ck", "clicks")
    assert sum(r[6] for p in records for r in PR.observed_rows(p)) == 4


def test_rows_without_observed_metrics():
    assert PR.observed_rows({"name": "q"}) == []
    assert PR.observed_rows({"observedMetrics": {"o": {"a": None, "b": "NaN", "c": 3}}}) == [
        (None, None, None, None, "o", "a", None), (None, None, None, None, "o", "b", None), (None, None, None, None, "o", "c", 3.0)]
    assert isinstance(PR.progress_row({})[0], dt.datetime)
