"""Catalogue queries for monitoring (G5), stream state, and the upsert sink.

The monitoring views read the 15-column metrics table (M1).  `metrics_table` derives one from
`events` by integer rules, an event type standing for a query and ten minutes for a batch, so the
views are checked row by row and their work grows with the table.  `stream_totals` and `state_rows`
read the progress and the state of the pipeline of `tidepool.plans.streams` itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.scalar import real_watermark, to_ntz
from tidepool.monitor import metrics as M
from tidepool.monitor.progress import OBSERVED_SCHEMA, PROGRESS_SCHEMA, metrics_folders
from tidepool.monitor.watchdog import quiet_queries
from tidepool.plans.memo import built_once
from tidepool.plans.streams import _REPLAY, CLASSIFIED_SQL, REDELIVERED, TRIGGER_BYTES, medallion
from tidepool.session import work_dir
from tidepool.sources.tables import read_events
from tidepool.streaming import checkpoint as C
from tidepool.streaming import layers as L
from tidepool.streaming.upsert import read_target, run_upsert

BATCH_SECONDS = 600
UPSERT_PARTITIONS = TRIGGER_BYTES >> 22  # 4 MB of a full trigger each; streaming has no adaptive coalescing
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 layout over `events`: one row per event type (query) and ten minutes (batch)."""
    ev = read_events(spark, sf_dir)
    one_in = lambda n: F.count_if(F.col("event_id") % n == 0)
    per = ev.groupBy("event_type", F.window("ts", f"{BATCH_SECONDS} seconds").start.alias("at")).agg(
        F.count("*").alias("n"), one_in(13).alias("late"), one_in(17).alias("again"), one_in(3).alias("slow"), F.count_distinct("user_id").alias("users"))
    first = ev.agg(F.floor(F.unix_timestamp(F.min("ts")) / BATCH_SECONDS)).scalar()
    batch = F.floor(F.unix_timestamp("at") / BATCH_SECONDS) - first
    trigger = 500 + F.col("n") % 700
    epoch = F.lit("1970-01-01T00:00:00.000Z")
    mark = F.when(batch == 0, epoch).otherwise(F.date_format(F.col("at") - F.expr("INTERVAL 15 MINUTES"), ISO_MILLIS))
    columns = {
        "logged_at": F.col("at") + F.expr(f"INTERVAL {BATCH_SECONDS} SECONDS"),
        "query_name": F.when(F.length("event_type") % 2 == 0, F.col("event_type")), "query_id": F.md5(F.col("event_type").cast("binary")),
        "run_id": F.lit("run"), "batch_id": batch, "batch_timestamp": F.col("at"), "num_input_rows": F.col("n"),
        "input_rows_per_sec": F.col("n") / 10.0, "processed_rows_per_sec": (F.col("n") - F.col("slow")) / 6.0,
        "trigger_ms": trigger, "add_batch_ms": trigger - 100, "watermark": mark, "state_rows": F.col("users"),
        "rows_dropped_by_watermark": F.col("late"), "duplicates_dropped": F.col("again"),
    }
    return M.labelled(per.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in PROGRESS_SCHEMA.fields]))


def _zoneless(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: to_ntz(f.name) for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


def pipeline_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3: the metrics rows that the listener persisted while the pipeline ran; query name = layer."""
    kept, _ = metrics_folders(medallion(spark, sf_dir).metrics_dir)
    return M.labelled(spark.read.schema(PROGRESS_SCHEMA).parquet(kept)).withColumn("query_name", _layer())


def _layer():
    return F.regexp_extract("query_name", r"^([a-z]+)_", 1)


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3: per layer, over the persisted rows: runs, input rows, duplicates dropped, the windows in
    state and the watermark at the end (every column of the metrics that a replay determines)."""
    p = pipeline_progress(spark, sf_dir)
    whole = F.count_if(F.col("logged_at").isNull() | F.col("query_id").isNull() | F.col("batch_timestamp").isNull() | (F.col("trigger_ms") < F.col("add_batch_ms")))
    per = p.groupBy(F.col("query_name").alias("layer")).agg(
        F.count_distinct("run_id").alias("runs"), F.count_distinct("query_id").alias("queries"), F.sum("num_input_rows").alias("input_rows"),
        F.sum("duplicates_dropped").alias("duplicates"), F.max_by("state_rows", F.struct("batch_timestamp", "batch_id")).alias("state"),
        F.max(real_watermark("watermark")).alias("mark"), whole.alias("broken_rows"))
    gold = F.col("layer") == "gold"
    return per.select("layer", "runs", "queries", "input_rows", F.when(F.col("layer") == "silver", F.col("duplicates")).alias("duplicates"),
                      F.when(gold, F.col("state")).alias("open_windows"), F.when(gold, to_ntz("mark")).alias("watermark"), "broken_rows")


def silver_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What silver observed on its way, summed over the batches the listener persisted."""
    _, kept = metrics_folders(medallion(spark, sf_dir).metrics_dir)
    o = spark.read.schema(OBSERVED_SCHEMA).parquet(kept).where(F.col("observed") == L.CHECKS)
    return o.groupBy("metric").agg(F.sum("value").cast("long").alias("total"))


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: input rows per layer of the pipeline, from the progress of its micro-batches."""
    t = M.totals(pipeline_progress(spark, sf_dir))
    return t.select(F.col("query_name").alias("layer"), "input_rows")


def stream_totals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches, input rows, last batch duration, dropped rows per query."""
    return M.totals(metrics_table(spark, sf_dir))


def backlog_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backlog over the last five batches and sustained backlog."""
    return M.backlog(metrics_table(spark, sf_dir))


def rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates in long form."""
    return _zoneless(M.rate_series(metrics_table(spark, sf_dir)))


def watermark_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark, state rows and drops over time."""
    return _zoneless(M.watermark_series(metrics_table(spark, sf_dir)))


def late_drop_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing 30-minute late-drop ratio with page and ticket flags."""
    return _zoneless(M.late_drop_ratio(metrics_table(spark, sf_dir)))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staleness of each query at the time of the newest event (10-minute trigger)."""
    now = read_events(spark, sf_dir).agg(F.max("ts")).scalar()
    return _zoneless(M.freshness(metrics_table(spark, sf_dir), now, trigger_seconds=BATCH_SECONDS, factor=1.0))


def quiet_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the freshness watchdog itself reported over the metrics of `events`, streamed in two runs
    of one checkpoint (the earlier half of the time, then the rest): an event type without a batch for three
    intervals."""

    def build() -> str:
        root = work_dir(spark, "watchdog")
        rows = metrics_table(spark, sf_dir).select("query_name", "batch_timestamp", "batch_id")
        half = rows.agg((F.min("batch_id") + F.max("batch_id")) / 2).scalar()
        early = F.col("batch_id") < half
        session = L.stream_session(spark)
        for part in (early, ~early):
            rows.where(part).write.mode("append").parquet(f"{root}/progress")
            src = L.layer_source(session, f"{root}/progress", rows.schema)
            L.drain(quiet_queries(src, BATCH_SECONDS), f"{root}/alerts", f"{root}/_checkpoint", "watchdog")
        return f"{root}/alerts"

    return _zoneless(spark.read.parquet(built_once(spark, sf_dir, "watchdog", ("events",), build)))


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still held in the gold query's state (the open windows)."""
    s = C.state_rows(spark, medallion(spark, sf_dir).checkpoint("gold"))
    return s.select(to_ntz("key.window.start").alias("window_start"), to_ntz("key.window.end").alias("window_end"),
                    F.col("key.event_type").alias("event_type"))


def state_lifetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window the gold query ever held, from the changes of its state: opened once, and closed
    unless it is still held."""
    lives = C.state_lifetimes(C.state_changes(spark, medallion(spark, sf_dir).checkpoint("gold")))
    return lives.select(to_ntz("key.window.start").alias("window_start"), to_ntz("key.window.end").alias("window_end"), F.col("key.event_type").alias("event_type"),
                        (F.col("updates") >= 1).alias("opened"), F.col("closed_in").isNotNull().alias("closed"),
                        F.coalesce(F.col("closed_in") > F.col("opened_in"), F.lit(True)).alias("in_order"))


def upsert_not_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's landing folder (one delivery redelivered) upserted by event id and time in
    batches of a fixed number of bytes, then the whole landing replayed once more through a fresh
    checkpoint: nothing doubles."""

    def build() -> str:
        run = medallion(spark, sf_dir)
        session = L.stream_session(spark, UPSERT_PARTITIONS)
        root = work_dir(spark, "upsert")
        for attempt in ("first", "replay"):
            src = L.bronze(session, run.landing, max_bytes_per_trigger=TRIGGER_BYTES).drop(L.SOURCE, L.INGESTED)
            run_upsert(L.silver_columns(src), f"{root}/target", f"{root}/_checkpoints/{attempt}", ["event_id", "event_ts"], "event_ts",
                       name=f"upsert_{attempt}")
        return f"{root}/target"

    t = read_target(spark, built_once(spark, sf_dir, "upsert", ("events",), build))
    return t.select("event_id", "user_id", "event_type", to_ntz("event_ts").alias("event_ts"), "value")


_METRICS = f"""WITH g AS (
  SELECT event_type, time_bucket(INTERVAL {BATCH_SECONDS} SECOND, ts) AS t, count(*) AS n, count(*) FILTER (event_id % 13 = 0) AS late,
         count(*) FILTER (event_id % 17 = 0) AS again, count(*) FILTER (event_id % 3 = 0) AS slow, count(DISTINCT user_id) AS users
  FROM events GROUP BY 1, 2),
p AS (SELECT CASE WHEN length(event_type) % 2 = 0 THEN event_type ELSE 'unnamed-' || left(md5(event_type), 8) END AS query_name,
             CAST(epoch(t) AS BIGINT) // {BATCH_SECONDS} - (SELECT CAST(floor(epoch(min(ts))) AS BIGINT) // {BATCH_SECONDS} FROM events) AS batch_id,
             t AS batch_timestamp, n, n / 10.0::DOUBLE AS i, (n - slow) / 6.0::DOUBLE AS o, 500 + n % 700 AS trigger_ms, late, again, users FROM g)"""

MONITORING_SQL = {
    "stream_totals": f"""
WITH n AS (SELECT count(*) AS rows FROM events),
d AS (SELECT count(*) AS rows FROM (
        SELECT least(event_id // ((SELECT count(*) FROM events) // 4), 3) AS base, event_id FROM events)
      WHERE CASE WHEN event_id % 13 = 0 THEN least(base + 1, 3) ELSE base END = {REDELIVERED})
SELECT 'bronze' AS layer, (SELECT rows FROM n) + (SELECT rows FROM d) AS input_rows
UNION ALL SELECT 'silver', (SELECT rows FROM n) + (SELECT rows FROM d)
UNION ALL SELECT 'gold', (SELECT rows FROM n)
""",
    "pipeline_metrics": f"""{CLASSIFIED_SQL},
n AS (SELECT count(*) AS rows, (SELECT count(*) FROM r WHERE delivery = {REDELIVERED}) AS again FROM r)
SELECT 'bronze' AS layer, 5 AS runs, 1 AS queries, rows + again AS input_rows, NULL::BIGINT AS duplicates, NULL::BIGINT AS open_windows, NULL::TIMESTAMP AS watermark,
       0 AS broken_rows FROM n
UNION ALL SELECT 'silver', 5, 1, rows + again, again, NULL, NULL, 0 FROM n
UNION ALL SELECT 'gold', 4, 1, rows, NULL, (SELECT count(DISTINCT (window_start, event_type)) FROM c WHERE open),
       (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 15 MINUTE FROM events), 0 FROM n
""",
    "silver_checks": f"""WITH {_REPLAY},
b AS (SELECT *, epoch_us(delivered_at) - epoch_us(ts) AS lag FROM (SELECT * FROM r UNION ALL SELECT * FROM r WHERE delivery = {REDELIVERED})),
t AS (SELECT count(*) AS rows, 0 AS bad_time, count(*) FILTER (props IS NOT NULL AND json_extract_string(props, '$.k') IS NULL) AS bad_props,
             count(*) FILTER (value IS NULL) AS no_value, count(*) FILTER (event_id IS NULL OR ts IS NULL) AS incomplete,
             sum(floor(lag / 1000000))::BIGINT AS lag_seconds, count(*) FILTER (lag > 900000000) AS overdue FROM b)
UNPIVOT (SELECT rows::BIGINT AS rows, bad_time::BIGINT AS bad_time, bad_props::BIGINT AS bad_props, no_value::BIGINT AS no_value,
         incomplete::BIGINT AS incomplete, lag_seconds, overdue::BIGINT AS overdue FROM t)
ON rows, bad_time, bad_props, no_value, incomplete, lag_seconds, overdue INTO NAME metric VALUE total
""",
    "state_rows": f"{CLASSIFIED_SQL} SELECT DISTINCT window_start, window_end, event_type FROM c WHERE open",
    "state_lifetimes": f"""{CLASSIFIED_SQL}
SELECT window_start, window_end, event_type, true AS opened, NOT bool_or(open) AS closed, true AS in_order FROM c WHERE NOT late GROUP BY 1, 2, 3
""",
    "stream_totals_full": f"""{_METRICS}
SELECT query_name, count(*) AS batches, sum(n)::BIGINT AS input_rows, arg_max(trigger_ms, batch_id) AS last_batch_ms, sum(late)::BIGINT AS dropped_rows
FROM p GROUP BY 1
""",
    "backlog_alert": f"""{_METRICS},
l AS (SELECT query_name, avg(i) AS avg_input_rate, avg(o) AS avg_processed_rate
      FROM (SELECT *, row_number() OVER (PARTITION BY query_name ORDER BY batch_id DESC) AS k FROM p) WHERE k <= 5 GROUP BY 1),
s AS (SELECT *, sum(CASE WHEN i > o THEN 0 ELSE 1 END) OVER (PARTITION BY query_name ORDER BY batch_id) AS run FROM p),
r AS (SELECT query_name, max(m) AS m FROM (SELECT query_name, run, (epoch(max(batch_timestamp)) - epoch(min(batch_timestamp))) / 60.0 AS m
      FROM s WHERE i > o GROUP BY 1, 2) GROUP BY 1)
SELECT query_name, avg_input_rate, avg_processed_rate, avg_input_rate > avg_processed_rate AS backlog,
       coalesce(m, 0.0)::DOUBLE AS longest_backlog_minutes, coalesce(m >= 10, false) AS sustained_backlog
FROM l LEFT JOIN r USING (query_name)
""",
    "rate_series": f"""{_METRICS}
SELECT query_name, batch_id, batch_timestamp, 'input' AS rate, i AS rows_per_sec FROM p
UNION ALL SELECT query_name, batch_id, batch_timestamp, 'processed', o FROM p
""",
    "watermark_series": f"""{_METRICS}
SELECT query_name, batch_id, batch_timestamp, CASE WHEN batch_id > 0 THEN batch_timestamp - INTERVAL 15 MINUTE END AS watermark,
       users AS state_rows, again AS duplicates_dropped, late AS rows_dropped_by_watermark FROM p
""",
    "late_drop_ratio": f"""{_METRICS},
w AS (SELECT *, sum(late) OVER t AS d, sum(n) OVER t AS r, sum(late) OVER (PARTITION BY query_name, batch_timestamp::DATE) AS today FROM p
      WINDOW t AS (PARTITION BY query_name ORDER BY batch_timestamp RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW))
SELECT query_name, batch_id, batch_timestamp, d::BIGINT AS dropped_30m, r::BIGINT AS input_30m, d::DOUBLE / nullif(r, 0) AS drop_ratio,
       coalesce(d::DOUBLE / nullif(r, 0) > 0.01, false) AS page, today > 0 AS ticket FROM w
""",
    "freshness": f"""{_METRICS}
SELECT query_name, max(batch_timestamp) AS last_batch,
       CAST(floor(epoch((SELECT max(ts) FROM events))) AS BIGINT) - CAST(epoch(max(batch_timestamp)) AS BIGINT) AS age_seconds,
       CAST(floor(epoch((SELECT max(ts) FROM events))) AS BIGINT) - CAST(epoch(max(batch_timestamp)) AS BIGINT) > {BATCH_SECONDS} AS stale
FROM p GROUP BY 1
""",
    "quiet_alerts": f"""{_METRICS},
n AS (SELECT query_name, batch_timestamp AS t, lead(batch_timestamp) OVER (PARTITION BY query_name ORDER BY batch_id) AS next FROM p)
SELECT query_name, t AS last_batch, t + INTERVAL {3 * BATCH_SECONDS} SECOND AS alert_at FROM n
WHERE coalesce(next, (SELECT max(batch_timestamp) FROM p)) > t + INTERVAL {3 * BATCH_SECONDS} SECOND
""",
    "upsert_not_matched": "SELECT event_id, user_id, event_type, ts AS event_ts, value FROM events",
}
