"""The bronze -> silver -> gold pipeline over a replay, its batch twin,
and the accounting of where the readings went.

Late-data rule (one `availableNow` drain per delivery, so a no-data batch runs between
deliveries and the watermark is current when the next delivery arrives):

    wm(b)   = max(event_ts over deliveries before b) - delay      (none for the first)
    dropped = the row's window_end <= wm(b)
    emitted = window_end <= max(event_ts over all rows) - delay

`gold_twin` computes the same result as plain batch DataFrame operations, so the stream is
tested against it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.session import work_dir
from tidepool.streaming import layers as L
from tidepool.streaming.replay import LATE_MOD, N_DELIVERIES, land, plan_deliveries

ROWS_PER_STATE_PARTITION = 1_000_000  # aggregations: rows are folded before they reach the state
KEYS_PER_STATE_PARTITION = 100_000  # deduplication: every row is a lookup and a key of the state


def state_partitions_for(rows_per_batch: int, rows_per_partition: int = ROWS_PER_STATE_PARTITION) -> int:
    """State store partitions for a stateful stream: one per `rows_per_partition` input rows of
    a micro-batch, at least 2.  Streaming has no adaptive coalescing and the number is fixed at
    the first start, so it is sized from the expected volume."""
    return max(2, -(-rows_per_batch // rows_per_partition))


@dataclass
class MedallionRun:
    root: str
    landing: str
    bronze_dir: str
    silver_dir: str
    gold_dir: str
    window: str
    delay: str
    key: str
    progress: list[dict] = field(default_factory=list)

    @property
    def metrics_dir(self) -> str:
        return os.path.join(self.root, "_metrics")

    def checkpoint(self, layer: str) -> str:
        return os.path.join(self.root, "_checkpoints", layer)


def run_medallion(spark: SparkSession, events: DataFrame, root: str | None = None, n_deliveries: int = N_DELIVERIES,
                  late_mod: int = LATE_MOD, redeliver: int | None = 1, window: str = L.GOLD_WINDOW,
                  delay: str = L.GOLD_DELAY, key: str = L.GOLD_KEY,
                  state_partitions: int | None = None) -> MedallionRun:
    """Replay `events` as deliveries and drain bronze, silver and gold once per delivery.

    With `redeliver=b`, delivery b lands a second time under new file names right after
    the first (a redelivered batch): bronze keeps both copies, silver keeps one.
    """
    root = root or work_dir(spark, "medallion")
    run = MedallionRun(root, f"{root}/landing", f"{root}/bronze", f"{root}/silver", f"{root}/gold",
                       window, delay, key)
    # The replay plan is written once (partitioned by delivery) so each landing reads only
    # its own partition instead of recomputing the plan from `events`.
    plan_dir = f"{root}/replay"
    plan_deliveries(events, n_deliveries, late_mod).write.partitionBy("delivery").parquet(plan_dir)
    planned = spark.read.parquet(plan_dir)
    windows = state_partitions
    if state_partitions is None:
        biggest = planned.groupBy("delivery").count().agg(F.max("count")).first()[0] or 0
        state_partitions, windows = state_partitions_for(biggest, KEYS_PER_STATE_PARTITION), state_partitions_for(biggest)
    streams = layer_streams(L.stream_session(spark, state_partitions), run, gold_session=L.stream_session(spark, windows))

    def drain_all(tag: str, layers=("bronze", "silver", "gold")) -> None:
        for name in layers:
            df, out = streams[name]
            for p in L.drain(df, out, run.checkpoint(name), f"{name}_{tag}", metrics_dir=run.metrics_dir):
                p["layer"] = name
                run.progress.append(p)

    for b in range(n_deliveries):
        land(planned, run.landing, b)
        drain_all(f"d{b}")
        if redeliver is not None and b == redeliver:
            land(planned, run.landing, b)
            # Silver drops every redelivered reading, so gold has nothing new to read.
            drain_all(f"d{b}_again", layers=("bronze", "silver"))
    return run


def layer_streams(session: SparkSession, run: MedallionRun, max_bytes_per_trigger: int | None = None,
                  gold_session: SparkSession | None = None) -> dict[str, tuple[DataFrame, str]]:
    """The three layers as unstarted streams of `session` (gold of its own, if given), each with its folder."""
    spec = L.LayerSpec(window=run.window, delay=run.delay, group_by=(run.key,))
    b = L.bronze(session, run.landing, max_bytes_per_trigger=max_bytes_per_trigger)
    s = L.silver(L.layer_source(session, run.bronze_dir, b.schema, max_bytes_per_trigger), spec)
    g = L.gold(L.layer_source(gold_session or session, run.silver_dir, s.schema, max_bytes_per_trigger), spec)
    return {"bronze": (b, run.bronze_dir), "silver": (s, run.silver_dir), "gold": (g, run.gold_dir)}


def read_layer(spark: SparkSession, layer_dir: str) -> DataFrame:
    """A layer folder read as a table (only files committed by the stream's log)."""
    return spark.read.parquet(layer_dir)


def watermarks_by_delivery(silver: DataFrame, delay: str) -> DataFrame:
    """(delivered_ts, wm): the watermark each delivery meets (NULL for the first).

    wm(d) = max event time over all earlier deliveries - delay: a running max, computed
    in two levels so no task holds every delivery: within each day (window partitioned by
    day), and across days over a table of one row per day (its size follows the time span,
    not the data).
    """
    per = (silver.groupBy("delivered_ts").agg(F.max("event_ts").alias("_mx"))
           .withColumn("_day", F.date_trunc("day", "delivered_ts")))
    within = Window.partitionBy("_day").orderBy("delivered_ts").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_prev_same_day", F.max("_mx").over(within))
    days = per.groupBy("_day").agg(F.max("_mx").alias("_day_mx"))
    across = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_day", F.max("_day_mx").over(across).alias("_prev_days"))
    # One row per day: small, but only known after the aggregation runs, so the join
    # strategy is left to adaptive execution, which measures the stage and broadcasts it
    # only under its size threshold (a shuffle join otherwise).
    j = per.join(days, "_day", "left")
    prev = F.greatest("_prev_same_day", "_prev_days")  # NULLs are skipped; both NULL -> NULL
    return j.select("delivered_ts", (prev - F.expr(f"INTERVAL {delay}")).alias("wm"))


def classify_rows(silver: DataFrame, window: str, delay: str) -> DataFrame:
    """Silver rows + window bounds + `late` (dropped by the watermark) + `open` (not final).

    The watermark table has one row per delivery; adaptive execution picks broadcast or
    shuffle for its join from the measured size.
    """
    wms = watermarks_by_delivery(silver, delay)
    final_wm = silver.agg(F.max("event_ts")).first()[0]
    rows = (silver.join(wms, "delivered_ts", "left")
            .withColumn("_w", F.window("event_ts", window))
            .withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")
            .withColumn("late", F.coalesce(F.col("window_end") <= F.col("wm"), F.lit(False))))
    if final_wm is None:
        return rows.withColumn("open", F.lit(False))
    fw = F.lit(final_wm).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    return rows.withColumn("open", ~F.col("late") & (F.col("window_end") > fw))


def gold_twin(silver: DataFrame, window: str = L.GOLD_WINDOW, delay: str = L.GOLD_DELAY,
              key: str = L.GOLD_KEY) -> DataFrame:
    """Batch twin of the gold stream: the same windows, counts and values."""
    rows = classify_rows(silver, window, delay).filter(~F.col("late") & ~F.col("open"))
    return (rows.groupBy("window_start", "window_end", key)
            .agg(F.count(F.lit(1)).alias("readings"), F.avg("value").alias("avg_value"),
                 F.max("value").alias("max_value")))


def silver_windows(spark: SparkSession, run: MedallionRun) -> DataFrame:
    """Silver rows per window and key, and whether the window was still open at the end: it ends
    after the final watermark (greatest event time less the delay).  One scan of silver; the
    table of windows is written, because the watermark is a maximum over it."""
    rows = read_layer(spark, run.silver_dir)
    per = rows.groupBy(F.window("event_ts", run.window).alias("w"), run.key).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.max("event_ts").alias("newest"))
    path = f"{work_dir(spark, 'windows')}/silver"
    per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), run.key, "silver_rows", "newest").write.parquet(path)
    per = spark.read.parquet(path)
    final = per.agg(F.max("newest") - F.expr(f"INTERVAL {run.delay}")).scalar()
    return per.withColumn("open", F.col("window_end") > final).drop("newest")


def accounting(spark: SparkSession, run: MedallionRun) -> DataFrame:
    """Bronze, silver, duplicates, gold, open and late rows in one row, each measured:
    open rows stand in open windows, late rows are closed silver rows that gold lacks, and
    bronze - silver = duplicates (+ invalid rows)."""
    bronze = read_layer(spark, run.bronze_dir).agg(F.count(F.lit(1))).scalar()
    gold = read_layer(spark, run.gold_dir).agg(F.coalesce(F.sum("readings"), F.lit(0))).scalar()
    silver = silver_windows(spark, run).agg(
        F.coalesce(F.sum("silver_rows"), F.lit(0)).alias("silver_rows"),
        F.coalesce(F.sum(F.when(F.col("open"), F.col("silver_rows"))), F.lit(0)).alias("open_rows"))
    rows = silver.select(bronze.alias("bronze_rows"), "silver_rows", gold.alias("gold_rows"), "open_rows")
    return rows.select("bronze_rows", "silver_rows", (F.col("bronze_rows") - F.col("silver_rows")).alias("duplicates"),
                       "gold_rows", "open_rows", (F.col("silver_rows") - F.col("open_rows") - F.col("gold_rows")).alias("late_rows"))


def reconcile(spark: SparkSession, run: MedallionRun) -> DataFrame:
    """Per window and key, silver rows against gold readings, with the reason for a gap.  What a
    closed window lacks in gold came late; an open one has no gold row yet."""
    at = ["window_start", "window_end", run.key]
    gold = read_layer(spark, run.gold_dir).select(*at, F.col("readings").alias("gold_rows"))
    j = silver_windows(spark, run).join(gold, at, "full_outer")
    silver_rows, gold_rows = (F.coalesce(c, F.lit(0)) for c in ("silver_rows", "gold_rows"))
    late = F.when(F.col("open"), F.lit(0)).otherwise(silver_rows - gold_rows)
    status = (F.when(F.col("gold_rows").isNull() & F.col("open"), "open")
              .when(F.col("open") | (late < 0) | F.col("silver_rows").isNull(), "mismatch")
              .when(F.col("gold_rows").isNull(), "all_late")
              .when(late == 0, "match").otherwise("some_late"))
    return j.select(*at, silver_rows.alias("silver_rows"), gold_rows.alias("gold_rows"), late.alias("late_rows"), status.alias("status"))


def run_live(spark: SparkSession, events: DataFrame, root: str | None = None, trigger: str = "1 second",
             n_deliveries: int = N_DELIVERIES, late_mod: int = LATE_MOD, redeliver: int | None = 1,
             metrics_dir: str | None = None) -> MedallionRun:
    """The same three layers as long-running queries on a processing-time
    trigger, fed delivery by delivery, with a listener persisting one metrics row per batch.

    Bronze and silver match the drained run; gold's late-row count can differ because a
    running query does not promise a no-data batch between two deliveries (use
    `run_medallion` where the documented late-data rule must hold).
    """
    from tidepool.monitor.progress import MetricsListener, attach, detach
    from tidepool.streaming import control

    root = root or work_dir(spark, "medallion-live")
    run = MedallionRun(root, f"{root}/landing", f"{root}/bronze", f"{root}/silver", f"{root}/gold",
                       L.GOLD_WINDOW, L.GOLD_DELAY, L.GOLD_KEY)
    plan_dir = f"{root}/replay"
    plan_deliveries(events, n_deliveries, late_mod).write.partitionBy("delivery").parquet(plan_dir)
    planned = spark.read.parquet(plan_dir)
    session = L.stream_session(spark)
    listener = MetricsListener(sink_dir=metrics_dir or run.metrics_dir, spark=spark)
    attach(session, listener)
    tag = os.path.basename(root)
    queries = []
    try:
        for name, (df, out) in layer_streams(session, run).items():
            queries.append(control.start(df, f"{name}_live_{tag}", out, run.checkpoint(name), every=trigger))
        for b in range(n_deliveries):
            copies = 2 if redeliver is not None and b == redeliver else 1
            for _ in range(copies):
                land(planned, run.landing, b)
                for q in queries:  # in layer order: each layer sees the one before it
                    q.processAllAvailable()
        control.drain_and_stop_all(session)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        listener.settle()
        detach(session, listener)
        listener.close()
    return run
