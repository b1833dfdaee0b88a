"""Streaming semantics: late data, resume, schema drift policies, dedup, control, logs."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.plans.compare import diff_rows
from tidepool.sources.tables import read_events, read_table
from tidepool.streaming import checkpoint as C
from tidepool.streaming import control
from tidepool.streaming import drift as D
from tidepool.streaming import layers as L
from tidepool.streaming import pipeline as P
from tidepool.streaming.replay import READINGS_SCHEMA, plan_deliveries

from conftest import SF001

# The nine readings of the late-data example: three deliveries of three.
NINE = [["12:02", "12:07", "12:14"], ["12:21", "12:28", "12:05"], ["12:33", "12:09", "12:16"]]


def _write_reading_file(folder, name, times, mtime):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        for i, t in enumerate(times):
            f.write(json.dumps({"event_id": hash((name, i)) & 0xFFFF, "event_time": f"2024-01-01T{t}:00",
                                "user_id": 1, "event_type": "d1", "value": 1.0, "props": '{"k": 1}',
                                "delivered_at": "2024-01-01T13:00:00"}) + "\n")
    os.utime(path, (mtime, mtime))


def _gold_of(spark, landing, max_files=None):
    src = spark.readStream.format("json").schema(READINGS_SCHEMA)
    if max_files:
        src = src.option("maxFilesPerTrigger", max_files)
    return L.gold(L.silver_columns(src.load(landing)))


def _window_1200(spark, out):
    g = spark.read.parquet(out).filter(F.date_format("window_start", "HH:mm") == "12:00")
    return g.select("readings").first()[0]


def _dropped(progress):
    return sum(o.get("numRowsDroppedByWatermark", 0) for p in progress for o in p.get("stateOperators", []))


def test_nine_readings_one_drain_per_delivery(spark, scratch):
    landing, out, ck = f"{scratch}/landing", f"{scratch}/gold", f"{scratch}/ck"
    os.makedirs(landing)
    progress = []
    for i, batch in enumerate(NINE):
        _write_reading_file(landing, f"b{i}.json", batch, time.time() - 100 + i)
        progress += L.drain(_gold_of(spark, landing), out, ck, f"nine_{i}")
    assert _window_1200(spark, out) == 3
    assert _dropped(progress) == 1


def test_nine_readings_single_drain_lags_one_batch(spark, scratch):
    landing, out, ck = f"{scratch}/landing", f"{scratch}/gold", f"{scratch}/ck"
    os.makedirs(landing)
    for i, batch in enumerate(NINE):
        _write_reading_file(landing, f"b{i}.json", batch, time.time() - 100 + i)
    progress = L.drain(_gold_of(spark, landing, max_files=1), out, ck, "nine_once")
    assert _window_1200(spark, out) == 4
    assert _dropped(progress) == 0


@pytest.fixture(scope="module")
def run(spark):
    return P.run_medallion(spark, read_events(spark, SF001))


def test_pipeline_accounting_small(spark, run):
    a = P.accounting(spark, run).first().asDict()
    assert a["silver_rows"] == 1000 and a["duplicates"] == a["bronze_rows"] - 1000
    assert (a["late_rows"], a["open_rows"], a["gold_rows"]) == (58, 1, 941)
    assert a["gold_rows"] + a["open_rows"] + a["late_rows"] == a["silver_rows"]


def test_gold_stream_equals_batch_twin(spark, run):
    gold = P.read_layer(spark, run.gold_dir)
    twin = P.gold_twin(P.read_layer(spark, run.silver_dir))
    cols = ["window_start", "window_end", "event_type", "readings", "avg_value", "max_value"]
    g = [tuple(r) for r in gold.select(cols).collect()]
    t = [tuple(r) for r in twin.select(cols).collect()]
    assert diff_rows(cols, g, cols, t) == []


def test_redelivery_kept_in_bronze_dropped_in_silver(spark, run):
    bronze = P.read_layer(spark, run.bronze_dir)
    assert bronze.count() - bronze.select("event_id").distinct().count() > 0
    silver = P.read_layer(spark, run.silver_dir)
    assert silver.count() == silver.select("event_id").distinct().count() == 1000


def test_checkpoint_logs_as_rows(spark, run):
    rows = C.checkpoint_rows(spark, run.checkpoint("gold"))
    offsets = rows.filter("log = 'offsets'")
    commits = rows.filter("log = 'commits'")
    assert offsets.select("batch_id").distinct().count() == commits.select("batch_id").distinct().count() > 0
    assert offsets.filter(F.col("batch_watermark_ms").isNotNull()).count() > 0


def test_state_holds_only_open_windows(spark, run):
    state = C.state_rows(spark, run.checkpoint("gold"))
    assert state.count() == 1  # the one open window at sf0.001


def test_resume_reads_only_new_files(spark, scratch):
    planned = plan_deliveries(read_table(spark, SF001, "events")).cache()
    landing, out, ck = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ck"
    from tidepool.streaming.replay import land

    b = L.bronze(spark, landing)
    land(planned, landing, 0)
    L.drain(b, out, ck, "resume_a")
    first = spark.read.parquet(out).count()
    land(planned, landing, 1)
    L.drain(b, out, ck, "resume_b")
    second = spark.read.parquet(out).count()
    n1 = planned.filter("delivery = 1").count()
    assert second - first == n1
    L.drain(b, out, ck, "resume_c")  # nothing new: nothing added
    assert spark.read.parquet(out).count() == second
    planned.unpersist()


def test_widen_schema_on_same_checkpoint(spark, scratch):
    landing, out, ck = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(landing)
    v1 = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    v2 = T.StructType(v1.fields + [T.StructField("battery_pct", T.LongType())])
    with open(f"{landing}/a.json", "w") as f:
        f.write('{"id": 1, "t": "x"}\n{"id": 2, "t": "y", "battery_pct": 50}\n')
    L.drain(spark.readStream.schema(v1).json(landing), out, ck, "widen_1")
    with open(f"{landing}/b.json", "w") as f:
        f.write('{"id": 3, "t": "z", "battery_pct": 70}\n')
    L.drain(spark.readStream.schema(v2).json(landing), out, ck, "widen_2")
    rows = {r["id"]: r["battery_pct"] for r in spark.read.option("mergeSchema", "true").parquet(out).collect()}
    assert rows == {1: None, 2: None, 3: 70}  # rows before the widening stay NULL


def test_fail_policy_stops_then_rereads_after_widening(spark, scratch):
    landing, sink, ck = f"{scratch}/landing", f"{scratch}/sink", f"{scratch}/ck"
    os.makedirs(landing)
    with open(f"{landing}/a.json", "w") as f:
        f.write('{"event_id": 1, "value": 2.0}\n{"event_id": 2, "value": 3.0, "battery_pct": 9}\n')
    narrow = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    q = (spark.readStream.format("text").load(landing).writeStream
         .foreachBatch(D.fail_on_unknown(sink, narrow)).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    with pytest.raises(Exception, match="battery_pct"):
        q.awaitTermination()
    wide = T.StructType(narrow.fields + [T.StructField("battery_pct", T.LongType())])
    q = (spark.readStream.format("text").load(landing).writeStream
         .foreachBatch(D.fail_on_unknown(sink, wide)).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 2  # the same file, read again


def test_append_without_watermark_is_refused(spark, scratch):
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    agg = (spark.readStream.schema(READINGS_SCHEMA).json(landing).groupBy("event_type").count())
    with pytest.raises(Exception, match="(?i)watermark"):
        L.drain(agg, f"{scratch}/o", f"{scratch}/ck", "no_wm")


def test_stream_session_uses_rocksdb_and_leaves_the_shared_settings(spark, scratch):
    from tidepool.streaming.replay import land

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    session = L.stream_session(spark, 3)
    planned = plan_deliveries(read_table(spark, SF001, "events"))
    landing = f"{scratch}/landing"
    land(planned, landing, 0)
    land(planned, landing, 0)  # redelivered
    L.drain(L.silver(L.bronze(session, landing)), f"{scratch}/silver", f"{scratch}/ck", "rocks")
    out = spark.read.parquet(f"{scratch}/silver")
    assert out.count() == out.select("event_id").distinct().count() == planned.filter("delivery = 0").count()
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert len([d for d in os.listdir(f"{scratch}/ck/state/0") if d.isdigit()]) == 3
    assert {k: spark.conf.get(k) for k in before} == before


def test_composite_dedup_key(spark, scratch):
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    rows = [(1, "x", "12:00"), (1, "x", "12:00"), (1, "x", "12:01"), (2, "x", "12:00"), (1, "y", "12:00")]
    with open(f"{landing}/a.json", "w") as f:
        for i, (user, kind, t) in enumerate(rows):
            f.write(json.dumps({"event_id": i, "event_time": f"2024-01-01T{t}:00", "user_id": user, "event_type": kind, "value": 1.0}) + "\n")
    spec = L.LayerSpec(dedup_key=("user_id", "event_ts"))
    L.drain(L.silver(L.bronze(spark, landing), spec), f"{scratch}/silver", f"{scratch}/ck", "composite")
    assert spark.read.parquet(f"{scratch}/silver").count() == 3


def test_progress_of_more_than_a_hundred_batches(spark, scratch):
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    for i in range(120):
        _write_reading_file(landing, f"b{i:03d}.json", ["12:00"], time.time() - 500 + i)
    source = L.bronze(spark, landing, max_files_per_trigger=1)
    records = L.drain(source, f"{scratch}/out", f"{scratch}/ck", "many", metrics_dir=f"{scratch}/metrics")
    assert len(records) == 120 and sum(r["numInputRows"] for r in records) == 120
    assert spark.read.parquet(f"{scratch}/metrics").agg(F.sum("num_input_rows")).first()[0] == 120


def test_bytes_bound_a_trigger(spark, scratch):
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    for i in range(6):
        _write_reading_file(landing, f"b{i}.json", ["12:00"], time.time() - 100 + i)
    size = max(os.path.getsize(f"{landing}/b{i}.json") for i in range(6))  # identifiers differ in length
    records = L.drain(L.bronze(spark, landing, max_bytes_per_trigger=2 * size), f"{scratch}/o", f"{scratch}/ck", "bytes")
    assert [r["numInputRows"] for r in records if r["numInputRows"]] == [2, 2, 2]


def _upsert(spark, target, rows, batch_id):
    from tidepool.streaming.upsert import insert_new

    df = spark.createDataFrame(rows, "device int, at timestamp, v int")
    insert_new(target, ["device", "at"], "at")(df, batch_id)


def test_upsert_identity(spark, scratch):
    import datetime as dt

    from tidepool.streaming.upsert import insert_new, quarantine_dir, read_target

    t = [dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 12)]
    target = f"{scratch}/target"
    first = [(1, t[0], 1), (None, t[0], 2), (2, None, 3), (1, t[0], 1)]
    for batch in (0, 0, 1):  # run, replayed, redelivered in another batch
        _upsert(spark, target, first, batch)
    _upsert(spark, target, [(9, None, 7)], 2)  # a batch without any time
    _upsert(spark, target, [(1, t[1], 5)], 3)  # the same device at another time is another reading
    assert sorted(((r.device or 0), r.at) for r in read_target(spark, target).collect()) == [(0, t[0]), (1, t[0]), (1, t[1])]
    held = spark.read.parquet(quarantine_dir(target))
    assert held.where("batch = 0").count() == 1 and held.where("batch = 2").count() == 1
    with pytest.raises(ValueError):
        insert_new(target, ["device"], "at")


def test_replayed_batch_of_the_failing_policy_writes_once(spark, scratch):
    lines = spark.createDataFrame([(json.dumps({"event_id": 1, "value": 2.0}),)], "value string")
    write = D.fail_on_unknown(f"{scratch}/sink")
    write(lines, 0)
    write(lines, 0)
    assert spark.read.parquet(f"{scratch}/sink").count() == 1


def test_unknown_field_error_names_every_field(spark, scratch):
    lines = spark.createDataFrame([(json.dumps({f"new_{i:02d}": i}),) for i in range(45)], "value string")
    with pytest.raises(D.UnknownFieldError) as e:
        D.fail_on_unknown(f"{scratch}/sink")(lines, 0)
    assert e.value.fields == [f"new_{i:02d}" for i in range(45)]


def test_quarantine_holds_each_row_once(spark, scratch):
    rows = D.rescue_columns(D.drift_lines(read_table(spark, SF001, "events"))).limit(200).persist()
    sink = D.quarantine(f"{scratch}/good", f"{scratch}/bad")
    sink(rows, 0)
    sink(rows, 0)
    good, bad = spark.read.parquet(f"{scratch}/good"), spark.read.parquet(f"{scratch}/bad")
    assert good.count() + bad.count() == 200 and bad.where("_rescued_data IS NULL").count() == 0 < bad.count()
    rows.unpersist()


def test_incomplete_snapshot_is_not_read(spark, scratch):
    from tidepool.streaming import modes

    spark.range(3).write.parquet(f"{scratch}/s/batch=0")
    spark.range(9).write.parquet(f"{scratch}/s/batch=1")
    os.remove(f"{scratch}/s/batch=1/_SUCCESS".replace("file:", ""))
    assert modes.latest_snapshot(spark, f"{scratch}/s").count() == 3
    assert modes.latest_snapshot(spark, f"{scratch}/none") is None


def test_query_control(spark, scratch):
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    df = spark.readStream.schema(READINGS_SCHEMA).json(landing)
    q = control.start(df, "ctl_a", f"{scratch}/o", f"{scratch}/ck", every="1 second")
    try:
        with pytest.raises(ValueError):
            control.start(df, "ctl_a", f"{scratch}/o2", f"{scratch}/ck2")
        assert control.stop_by_name(spark, "ctl_a")
        assert not q.isActive
    finally:
        if q.isActive:
            q.stop()


def test_json_drift_detects_new_field(spark, scratch):
    landing = f"{scratch}/lines"
    D.land_lines(D.drift_lines(read_table(spark, SF001, "events")), landing)
    from tidepool.sources.tables import json_drift

    assert json_drift(spark, landing, D.DRIFT_SCHEMA) == ["battery_pct"]


def test_live_pipeline_with_listener(spark, scratch):
    run = P.run_live(spark, read_events(spark, SF001), root=f"{scratch}/live", trigger="500 milliseconds",
                     metrics_dir=f"{scratch}/metrics")
    silver = P.read_layer(spark, run.silver_dir)
    assert silver.count() == silver.select("event_id").distinct().count() == 1000
    bronze = P.read_layer(spark, run.bronze_dir)
    assert bronze.count() > 1000  # the redelivered copy is kept in bronze
    m = spark.read.parquet(f"{scratch}/metrics")
    names = {r[0].split("_live_")[0] for r in m.select("query_name").distinct().collect()}
    assert names == {"bronze", "silver", "gold"}
    per = {r[0].split("_live_")[0]: r[1] for r in m.groupBy("query_name").agg(F.sum("num_input_rows")).collect()}
    assert per["bronze"] == bronze.count() and per["gold"] == 1000
    assert not [q for q in spark.streams.active if "_live_" in (q.name or "")]


def test_complete_and_update_modes_span_batches(spark):
    from tidepool.plans import streams as PS
    from tidepool.streaming import modes

    run = PS._mode_run(spark, SF001)
    assert len(modes.snapshots(spark, run.complete_dir)) == modes.KEPT_SNAPSHOTS
    assert len(modes._names(spark, f"{run.update_dir}/visible", "")) >= 2  # several batches
    for q in (PS.complete_counts, PS.update_counts, PS.update_user_counts):
        assert q(spark, SF001).agg(F.sum("n")).first()[0] == 1000


def test_complete_counts_drains_no_other_stream(spark, scratch, monkeypatch):
    from types import SimpleNamespace

    from tidepool.plans import streams as PS
    from tidepool.streaming import modes

    rows = spark.createDataFrame([(i, "ab"[i % 2] if i % 5 else None) for i in range(30)], "event_id long, event_type string")
    rows.write.parquet(f"{scratch}/silver")
    rows.write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(PS, "medallion", lambda *_: SimpleNamespace(silver_dir=f"{scratch}/silver"))
    monkeypatch.setattr(modes, "drain_update", lambda *_: pytest.fail("update mode is not asked for"))
    assert {r.event_type: r.n for r in PS.complete_counts(spark, scratch).collect()} == {"a": 12, "b": 12, None: 6}


def _files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-")}


def _counts_stream(spark, landing):
    return spark.readStream.schema("k string, extra string").json(landing).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def test_update_mode_leaves_other_buckets_alone(spark, scratch):
    from tidepool.streaming import modes

    landing, target = f"{scratch}/in", f"{scratch}/t"
    put = lambda keys: spark.createDataFrame([(k, "x") for k in keys], "k string, extra string").write.mode("append").json(landing)
    put([f"k{i}" for i in range(40)] + [None, None])
    drain = lambda: modes.drain_update(_counts_stream(spark, landing), target, f"{scratch}/ck", ["k"], "buckets", buckets=8)
    drain()
    before = _files(target)
    put(["k0", "k0", "new", None])
    drain()
    after = _files(target)
    rows = spark.createDataFrame([("k0",), ("new",), (None,)], "k string")
    touched = {r[0] for r in rows.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()}
    bucket = lambda f: int(f.split(f"{modes.BUCKET}=")[1].split("/")[0])
    assert {f: t for f, t in before.items() if bucket(f) not in touched} == {f: t for f, t in after.items() if bucket(f) not in touched}
    assert {bucket(f) for f in after.keys() - before.keys()} == touched and len(touched) < 8
    want = {f"k{i}": 1 for i in range(1, 40)} | {"k0": 3, "new": 1, None: 3}
    assert {r.k: r.n for r in modes.read_buckets(spark, target).collect()} == want
    with pytest.raises(ValueError, match="buckets"):
        modes.drain_update(_counts_stream(spark, landing), target, f"{scratch}/ck", ["k"], "buckets", buckets=4)


def test_update_mode_survives_an_interrupted_batch(spark, scratch):
    """A batch whose data is written but not yet visible changes nothing for readers, and is replaced when it runs again."""
    import shutil

    from tidepool.streaming import modes

    landing, target = f"{scratch}/in", f"{scratch}/t"
    put = lambda keys: spark.createDataFrame([(k, "x") for k in keys], "k string, extra string").write.mode("append").json(landing)
    drain = lambda: modes.drain_update(_counts_stream(spark, landing), target, f"{scratch}/ck", ["k"], "again", buckets=4)
    assert modes.read_buckets(spark, target) is None
    put(["a", "b", "c"])
    drain()
    put(["a", "d"])
    drain()
    last = max(modes._names(spark, f"{target}/visible", ""))
    shutil.rmtree(f"{target}/visible/{last}".replace("file:", ""))
    assert {r.k: r.n for r in modes.read_buckets(spark, target).collect()} == {"a": 1, "b": 1, "c": 1}
    commits = f"{scratch}/ck/commits".replace("file:", "")
    for f in os.listdir(commits):
        if f.strip(".").split(".")[0] == str(last):
            os.remove(os.path.join(commits, f))
    drain()  # the batch runs again
    assert {r.k: r.n for r in modes.read_buckets(spark, target).collect()} == {"a": 2, "b": 1, "c": 1, "d": 1}


def test_state_changes_balance(spark, run):
    """Windows opened minus windows closed are those still held, batch by batch too."""
    changes = C.state_changes(spark, run.checkpoint("gold"))
    lives = C.state_lifetimes(changes).persist()
    held = {r[0] for r in C.state_rows(spark, run.checkpoint("gold")).select("key").collect()}
    assert {r["key"] for r in lives.where("closed_in IS NULL").collect()} == held and held
    closed = lives.where("closed_in IS NOT NULL")
    assert closed.count() == spark.read.parquet(run.gold_dir).count() and closed.where("closed_in <= opened_in").count() == 0
    last = changes.agg(F.max("batch_id")).first()[0]
    first_half = C.state_changes(spark, run.checkpoint("gold"), 0, last // 2)
    assert first_half.count() == changes.where(F.col("batch_id") <= last // 2).count() > 0
    lives.unpersist()


def test_accounting_scans_each_layer_once(spark, run):
    from tidepool.plans.inspect import plan_text

    text = plan_text(P.accounting(spark, run))
    assert len([line for line in text.splitlines() if line.startswith("Location") and ("bronze" in line or "gold" in line)]) <= 2
    assert P.accounting(spark, run).first().late_rows == 58


def test_gold_stream_folds_hot_keys_before_the_state_shuffle(spark, scratch):
    from tidepool.plans.inspect import plan_text

    os.makedirs(f"{scratch}/in")
    g = _gold_of(spark, f"{scratch}/in")
    text = plan_text(g, "simple")
    # Top-down text: the state store exchange sits above a partial aggregate, so a hot
    # (window, key) crosses the shuffle as one partial row per task.
    assert "REQUIRED_BY_STATEFUL_OPERATOR" in text and "partial_count(1)" in text
    assert text.index("REQUIRED_BY_STATEFUL_OPERATOR") < text.index("partial_count(1)")
    assert "EventTimeWatermark" in text  # the late-row filter and state eviction use the watermark


def test_deduplication_state_grows_with_the_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(P, "KEYS_PER_STATE_PARTITION", 20, raising=False)
    events = spark.range(400).select(
        "id", (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
        F.timestamp_seconds(F.col("id") * 30).cast("timestamp_ntz").alias("ts")).withColumnRenamed("id", "event_id")
    run = P.run_medallion(spark, events, f"{scratch}/m")
    parts = {layer: len([d for d in os.listdir(f"{run.checkpoint(layer)}/state/0") if d.isdigit()]) for layer in ("silver", "gold")}
    assert parts == {"silver": 6, "gold": 2}  # the largest delivery has 107 rows
    assert P.read_layer(spark, run.silver_dir).count() == 400
    twin = P.gold_twin(P.read_layer(spark, run.silver_dir))
    assert sum(r["readings"] for r in P.read_layer(spark, run.gold_dir).collect()) == sum(r["readings"] for r in twin.collect())


def test_upsert_reads_only_the_key_ranges_of_the_batch(spark):
    from tidepool.streaming.upsert import key_ranges

    rows = "device int, name string, at double"
    held = spark.createDataFrame([(i, None if i % 5 == 0 else f"n{i}", float(i)) for i in range(10)] + [(None, "n3", 1.0)], rows)
    read = lambda batch: sorted((r.device is None, r.device) for r in held.where(key_ranges(spark.createDataFrame(batch, rows), ["device", "name", "at"])).collect())
    assert read([(3, "n3", 0.0), (4, "n4", 9.0)]) == [(False, 3), (False, 4)]
    assert read([(5, None, 0.0)]) == [(False, 5)]  # a NULL is equal to a NULL
    assert read([(None, "n3", 0.0)]) == [(True, None)]
    assert read([(None, "n3", 0.0), (2, "n1", 0.0)]) == [(False, 2), (True, None)]
    assert read([]) == []
