"""Catalogue queries over the streaming pipeline (G4) run on a replay of `events`.

The pipeline (bronze -> silver -> gold, four deliveries, delivery 1 redelivered) runs once
per application and state of the input; each query reads one of its layers back as a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.scalar import rounded, to_ntz
from tidepool.monitor.metrics import lag_alert as alert
from tidepool.operators.aggregate import ranked_percentiles
from tidepool.operators.sketches import merged_quantiles, quantile_sketches, rank_errors
from tidepool.plans.memo import built_once
from tidepool.session import work_dir
from tidepool.sources.tables import read_events
from tidepool.streaming import modes
from tidepool.streaming import pipeline as P
from tidepool.streaming.layers import GOLD_DELAY, GOLD_WINDOW, layer_source, stream_session
from tidepool.streaming.replay import LATE_MOD, N_DELIVERIES

REDELIVERED = 1


def medallion(spark: SparkSession, sf_dir: str) -> P.MedallionRun:
    return built_once(spark, sf_dir, "medallion", ("events",),
                      lambda: P.run_medallion(spark, read_events(spark, sf_dir), redeliver=REDELIVERED))


def bronze_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed reading, redelivered copies included, each file once."""
    b = P.read_layer(spark, medallion(spark, sf_dir).bronze_dir)
    return b.select("event_id", "event_time", "user_id", "event_type", "value", "props", "delivered_at")


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings, one per event id."""
    s = P.read_layer(spark, medallion(spark, sf_dir).silver_dir)
    return s.select("event_id", "user_id", "event_type", to_ntz("event_ts").alias("event_ts"), "value", "k",
                    to_ntz("delivered_ts").alias("delivered_ts"))


def gold_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final 10-minute windows per event type, late rows dropped."""
    g = P.read_layer(spark, medallion(spark, sf_dir).gold_dir)
    return g.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                    "event_type", "readings", rounded("avg_value", 6).alias("avg_value"), "max_value")


def pipeline_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver, duplicates, gold, open and late rows."""
    return P.accounting(spark, medallion(spark, sf_dir))


def window_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver vs gold per window, with the reason for each gap."""
    r = P.reconcile(spark, medallion(spark, sf_dir))
    return r.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                    "event_type", "silver_rows", "gold_rows", "late_rows", "status")


def lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p50 / p95 / p99 of ingestion lag (whole seconds) per event type, exact, by
    rank (five event types over all readings: each group is a hot group)."""
    s = P.read_layer(spark, medallion(spark, sf_dir).silver_dir)
    lag = F.floor((F.unix_micros("delivered_ts") - F.unix_micros("event_ts")) / 1_000_000).cast("long")
    return ranked_percentiles(s.withColumn("lag_s", lag), ["event_type"], "lag_s", [0.5, 0.95, 0.99],
                              ["p50", "p95", "p99"], digits=3)


LAG_RANKS, LAG_NAMES, LAG_ERROR = [0.5, 0.95, 0.99], ["p50", "p95", "p99"], 0.01


def lag_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion lag per event type from stored hourly sketches, merged over the hours of the later
    half of the time: the values that went in, and whether each quantile's exact rank is within 1 %."""
    s = P.read_layer(spark, medallion(spark, sf_dir).silver_dir)
    lag = F.floor((F.unix_micros("delivered_ts") - F.unix_micros("event_ts")) / 1_000_000).cast("long")
    s = s.withColumn("lag_s", lag)
    path = f"{work_dir(spark, 'sketches')}/hours"
    quantile_sketches(s, ["event_type"], "event_ts", "lag_s", LAG_ERROR).write.parquet(path)
    stored = spark.read.parquet(path)
    ends = s.agg(F.unix_timestamp(F.min("event_ts")).alias("lo"), F.unix_timestamp(F.max("event_ts")).alias("hi"))
    since = F.date_trunc("hour", F.timestamp_seconds(F.floor((F.col("lo") + F.col("hi")) / 2)))
    since = ends.select(since).scalar()
    got = merged_quantiles(stored.where(F.col("hour") >= since), ["event_type"], LAG_RANKS, LAG_NAMES)
    errors = rank_errors(s.where(F.date_trunc("hour", "event_ts") >= since), ["event_type"], "lag_s", got, LAG_RANKS, LAG_NAMES)
    within = errors.select("event_type", *[(F.col(n) <= LAG_ERROR).alias(f"{n}_within") for n in LAG_NAMES])
    return got.select("event_type", "rows", "n").join(within, "event_type")


def lag_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: ticket per event type when the p99 ingestion lag exceeds 80 % of the watermark delay."""
    delay_s = int(GOLD_DELAY.split()[0]) * 60
    return alert(lag_percentiles(spark, sf_dir).select("event_type", "p99"), delay_s)


TRIGGER_BYTES = 64 << 20


@dataclass(frozen=True)
class ModeRun:
    complete_dir: str
    update_dir: str
    users_dir: str


def _drain_halves(spark: SparkSession, sf_dir: str, root: str, drain: Callable[[DataFrame], None]) -> None:
    """Land the silver layer under `root` and drain it twice: after the events of even id have landed, and
    after the others have.  A trigger takes a fixed number of bytes at most."""
    rows = P.read_layer(spark, medallion(spark, sf_dir).silver_dir)
    session = stream_session(spark, P.state_partitions_for(rows.count()))
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/landing")
        drain(layer_source(session, f"{root}/landing", rows.schema, TRIGGER_BYTES))


def _complete_dir(spark: SparkSession, sf_dir: str) -> str:
    """Running counts over the silver layer in complete mode."""

    def build() -> str:
        root = work_dir(spark, "complete")
        _drain_halves(spark, sf_dir, root, lambda src: modes.drain_complete(
            modes.running_counts(src, "event_type"), f"{root}/complete", f"{root}/_checkpoints/complete", "counts_complete"))
        return f"{root}/complete"

    return built_once(spark, sf_dir, "complete", ("events",), build)


def _update_dirs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The same in update mode, by event type and by user; none of it is done for complete mode."""

    def build() -> dict[str, str]:
        root = work_dir(spark, "update")
        dirs = {key: f"{root}/{key}" for key in ("event_type", "user_id")}

        def drain(src: DataFrame) -> None:
            for key, to in dirs.items():
                modes.drain_update(modes.running_counts(src, key), to, f"{root}/_checkpoints/{key}", [key], f"counts_{key}")

        _drain_halves(spark, sf_dir, root, drain)
        return dirs

    return built_once(spark, sf_dir, "update", ("events",), build)


def _mode_run(spark: SparkSession, sf_dir: str) -> ModeRun:
    dirs = _update_dirs(spark, sf_dir)
    return ModeRun(_complete_dir(spark, sf_dir), dirs["event_type"], dirs["user_id"])


def complete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode, the newest snapshot of the running counts."""
    return modes.latest_snapshot(spark, _complete_dir(spark, sf_dir))


def update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode, the buckets that every batch was upserted into."""
    return modes.read_buckets(spark, _update_dirs(spark, sf_dir)["event_type"])


def update_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per user."""
    return modes.read_buckets(spark, _update_dirs(spark, sf_dir)["user_id"])


def event_vs_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per day by event time and by delivery (processing) time."""
    s = P.read_layer(spark, medallion(spark, sf_dir).silver_dir)
    by_event = s.groupBy(F.window("event_ts", "1 day").start.alias("day")).agg(F.count(F.lit(1)).alias("by_event_time"))
    by_proc = s.groupBy(F.window("delivered_ts", "1 day").start.alias("day")).agg(
        F.count(F.lit(1)).alias("by_processing_time"))
    j = by_event.join(by_proc, "day", "full_outer")
    return j.select(to_ntz("day").alias("day"), F.coalesce("by_event_time", F.lit(0)).alias("by_event_time"),
                    F.coalesce("by_processing_time", F.lit(0)).alias("by_processing_time"))


# --- SQL twins ---------------------------------------------------------------------------

_FMT = "'%Y-%m-%dT%H:%M:%S.%f'"
_DELAY_SQL = "INTERVAL " + GOLD_DELAY.split()[0] + " MINUTE"
_WIN_SQL = "INTERVAL " + GOLD_WINDOW.split()[0] + " MINUTE"
_LAST = N_DELIVERIES - 1

# Replay plan: delivery and delivery time per reading (same integer rule as the stream's).
_REPLAY = f"""
_b AS (SELECT *, least(event_id // ((SELECT count(*) FROM events) // {N_DELIVERIES}), {_LAST}) AS base FROM events),
_r AS (SELECT *, CASE WHEN event_id % {LATE_MOD} = 0 THEN least(base + 1, {_LAST}) ELSE base END AS delivery FROM _b),
_dt AS (SELECT delivery, max(ts) AS delivered_at FROM _r WHERE delivery = base GROUP BY 1),
r AS (SELECT _r.*, _dt.delivered_at FROM _r JOIN _dt USING (delivery))"""

CLASSIFIED_SQL = f"""WITH {_REPLAY},
_d AS (SELECT delivery, max(ts) AS mx FROM r GROUP BY 1),
_wm AS (SELECT delivery, max(mx) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        - {_DELAY_SQL} AS wm FROM _d),
x AS (SELECT r.*, time_bucket({_WIN_SQL}, ts) AS window_start, time_bucket({_WIN_SQL}, ts) + {_WIN_SQL} AS window_end,
             coalesce(time_bucket({_WIN_SQL}, ts) + {_WIN_SQL} <= _wm.wm, false) AS late
      FROM r JOIN _wm USING (delivery)),
c AS (SELECT *, NOT late AND window_end > (SELECT max(ts) FROM events) - {_DELAY_SQL} AS open FROM x)"""

STREAM_SQL = {
    "bronze_resume": f"""WITH {_REPLAY}
SELECT event_id, strftime(ts, {_FMT}) AS event_time, user_id, event_type, value, props,
       strftime(delivered_at, {_FMT}) AS delivered_at
FROM (SELECT * FROM r UNION ALL SELECT * FROM r WHERE delivery = {REDELIVERED})
""",
    "silver_dedup": f"""WITH {_REPLAY}
SELECT event_id, user_id, event_type, ts AS event_ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       delivered_at AS delivered_ts FROM r
""",
    "gold_windows": f"""{CLASSIFIED_SQL}
SELECT window_start, window_end, event_type, count(*) AS readings, round(avg(value), 6) AS avg_value,
       max(value) AS max_value
FROM c WHERE NOT late AND NOT open GROUP BY 1, 2, 3
""",
    "pipeline_accounting": f"""{CLASSIFIED_SQL}
SELECT (SELECT count(*) FROM r) + (SELECT count(*) FROM r WHERE delivery = {REDELIVERED}) AS bronze_rows,
       count(*) AS silver_rows,
       (SELECT count(*) FROM r WHERE delivery = {REDELIVERED}) AS duplicates,
       count(*) FILTER (WHERE NOT late AND NOT open) AS gold_rows,
       count(*) FILTER (WHERE open) AS open_rows,
       count(*) FILTER (WHERE late) AS late_rows
FROM c
""",
    "window_reconciliation": f"""{CLASSIFIED_SQL},
w AS (SELECT window_start, window_end, event_type, count(*) AS silver_rows,
             count(*) FILTER (WHERE late) AS late_rows, bool_or(open) AS is_open,
             count(*) FILTER (WHERE NOT late AND NOT open) AS kept
      FROM c GROUP BY 1, 2, 3)
SELECT window_start, window_end, event_type, silver_rows, kept AS gold_rows, late_rows,
       CASE WHEN is_open THEN 'open'
            WHEN kept = 0 THEN 'all_late'
            WHEN kept = silver_rows THEN 'match'
            ELSE 'some_late' END AS status
FROM w
""",
    "lag_percentiles": f"""WITH {_REPLAY},
l AS (SELECT event_type, CAST(floor((epoch_us(delivered_at) - epoch_us(ts)) / 1000000) AS BIGINT) AS lag_s FROM r)
SELECT event_type, count(*) AS n, round(quantile_cont(lag_s, 0.5), 3) AS p50, round(quantile_cont(lag_s, 0.95), 3) AS p95,
       round(quantile_cont(lag_s, 0.99), 3) AS p99
FROM l GROUP BY 1
""",
    "lag_sketches": """
SELECT event_type, count(*) AS rows, count(*) AS n, true AS p50_within, true AS p95_within, true AS p99_within
FROM events WHERE date_trunc('hour', ts) >= (SELECT date_trunc('hour', to_timestamp((floor(epoch(min(ts))) + floor(epoch(max(ts)))) // 2)::TIMESTAMP) FROM events)
GROUP BY 1
""",
    "lag_alert": f"""WITH {_REPLAY},
l AS (SELECT event_type, CAST(floor((epoch_us(delivered_at) - epoch_us(ts)) / 1000000) AS BIGINT) AS lag_s FROM r)
SELECT event_type, round(quantile_cont(lag_s, 0.99), 3) AS p99,
       round(quantile_cont(lag_s, 0.99), 3) > 0.8 * {int(GOLD_DELAY.split()[0]) * 60} AS ticket
FROM l GROUP BY 1
""",
    "complete_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "update_user_counts": "SELECT user_id, count(*) AS n FROM events GROUP BY 1",
    "update_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "event_vs_processing_time": f"""WITH {_REPLAY},
e AS (SELECT date_trunc('day', ts) AS day, count(*) AS by_event_time FROM r GROUP BY 1),
p AS (SELECT date_trunc('day', delivered_at) AS day, count(*) AS by_processing_time FROM r GROUP BY 1)
SELECT coalesce(e.day, p.day) AS day, coalesce(by_event_time, 0) AS by_event_time,
       coalesce(by_processing_time, 0) AS by_processing_time
FROM e FULL OUTER JOIN p ON e.day = p.day
""",
}
