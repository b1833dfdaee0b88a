"""Sources, sinks and catalog DDL (S1-S8, K1-K18), aggregation helpers."""

import os

from pyspark.sql import functions as F

from tidepool.operators import aggregate as A
from tidepool.operators import order as O
from tidepool.operators import sinks
from tidepool.plans.inspect import job_description, partition_sweep, aqe_compare, schema_string
from tidepool.sources import catalog as K
from tidepool.sources import tables as S

from conftest import SF001


def test_csv_header_inferred_and_ddl(spark, scratch):
    path = f"{scratch}/candy"
    o = S.read_table(spark, SF001, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    o.write.option("header", True).csv(path)
    inferred = S.read_csv(spark, path)
    assert dict(inferred.dtypes)["o_orderkey"] in ("int", "bigint") and inferred.count() == 1500
    fixed = S.read_csv(spark, path, header=True, schema="status STRING, priority STRING, key BIGINT")
    assert fixed.filter(F.col("key").isNull()).count() == 0
    no_header = S.read_csv(spark, path, header=False, schema="status STRING, priority STRING, key BIGINT")
    assert no_header.filter(F.col("key").isNull()).count() > 0  # header lines became rows


def test_local_rows_empty_range(spark):
    people = S.from_rows(spark, [("Brooke", 20), ("Denny", 31), ("Jules", 30), ("TD", 35), ("Brooke", 25)],
                         "name string, age long")
    avg = {r["name"]: r["avg_age"] for r in A.avg_by(people, ["name"], "age", "avg_age").collect()}
    assert avg["Brooke"] == 22.5
    assert S.empty_like(spark, people.schema).count() == 0
    assert S.id_range(spark, 100, "join_key").agg(F.max("join_key")).first()[0] == 99


def test_database_table_lifecycle(spark, scratch):
    db = "tp_test_db"
    K.create_database(spark, db, f"{scratch}/{db}.db")
    try:
        K.create_table(spark, f"{db}.flights", "date STRING, delay INT, distance INT, origin STRING, destination STRING")
        assert K.table_exists(spark, f"{db}.flights")
        K.save_table(S.read_table(spark, SF001, "orders"), f"{db}.orders", files=3)
        inv = {r["table"]: r for r in K.table_inventory(spark, db).collect()}
        assert inv["orders"]["provider"] == "parquet" and inv["orders"]["location"].endswith("orders")
        loc = K.table_location(spark, f"{db}.orders").replace("file:", "")
        assert len([f for f in os.listdir(loc) if f.endswith(".parquet")]) == 3
        assert S.catalog_table(spark, f"{db}.orders").count() == 1500
        K.create_or_replace(spark.range(5), f"{db}.five")
        K.create_or_replace(spark.range(7), f"{db}.five")
        assert spark.table(f"{db}.five").count() == 7
        K.drop_table(spark, f"{db}.flights")
        assert not K.table_exists(spark, f"{db}.flights")
    finally:
        K.drop_database(spark, db, cascade=True)
    assert db not in [d.name for d in spark.catalog.listDatabases()]


def test_sinks(spark, scratch):
    o = S.read_table(spark, SF001, "orders")
    sinks.write_parquet(o, f"{scratch}/capped", max_records_per_file=500, files=1)
    files = [f for f in os.listdir(f"{scratch}/capped") if f.endswith(".parquet")]
    assert len(files) == 3 and os.path.exists(f"{scratch}/capped/_SUCCESS")
    sinks.write_json(o.limit(5), f"{scratch}/json")
    assert spark.read.json(f"{scratch}/json").count() == 5
    sinks.run_noop(o)
    narrow = spark.createDataFrame([(1,)], "id long")
    wide = spark.createDataFrame([(2, 9)], "id long, extra long")
    narrow.write.parquet(f"{scratch}/m")
    wide.write.mode("append").parquet(f"{scratch}/m")
    assert sorted(sinks.read_merged(spark, f"{scratch}/m").columns) == ["extra", "id"]


def test_capped_files_tells_the_files_themselves(spark, scratch):
    from tidepool.plans.sources import capped_files

    def orders(lo, hi):
        status = F.when(F.col("id") % 10 < 6, "F").when(F.col("id") % 10 < 9, "O")
        return spark.range(lo, hi, 1, 3).select(F.col("id").alias("o_orderkey"), status.alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))

    orders(0, 450).write.parquet(f"{scratch}/orders.parquet")
    orders(0, 250).write.mode("append").parquet(f"{scratch}/orders.parquet")  # keys come twice, one status is null
    got = {r.o_orderstatus: tuple(r)[1:] for r in capped_files(spark, scratch).select("o_orderstatus", "files", "rows", "largest", "kept_to_cap", "enough_files").collect()}
    assert got == {"F": (5, 420, 100, True, True), "O": (3, 210, 100, True, True), None: (1, 70, 70, True, True)}


def test_rows_are_numbered_across_files_and_blocks(spark, scratch, monkeypatch):
    from tidepool.operators import layout as LY

    monkeypatch.setattr(LY, "BLOCK_ROWS", 7)
    spark.range(0, 100, 1, 3).selectExpr("id", "nullif(id % 3, 2) AS g").write.parquet(f"{scratch}/rows")
    got = LY.numbered(spark.read.parquet(f"{scratch}/rows"), ["g"])
    assert got.columns == ["id", "g", LY.NUMBER]
    by = {}
    for r in got.collect():
        by.setdefault(r.g, []).append((r[LY.NUMBER], r.id))
    assert {g: [n for n, _ in sorted(v)] for g, v in by.items()} == {0: [*range(34)], 1: [*range(33)], None: [*range(33)]}
    assert sorted(i for v in by.values() for _, i in v) == [*range(100)]


def test_describe_and_summary(spark):
    li = S.read_table(spark, SF001, "lineitem")
    d = {r["summary"]: r for r in A.describe(li, ["l_quantity"]).collect()}
    assert d["count"]["l_quantity"] == "6000"
    s = A.summary_stats(li, ["l_quantity"]).first()
    assert s["n"] == 6000 and s["min_value"] >= 1 and s["max_value"] <= 50


def test_order_helpers(spark):
    ev = S.read_table(spark, SF001, "events")
    newest = O.newest(ev, "ts", 20, tie="event_id").collect()
    assert len(newest) == 20 and newest[0]["event_id"] == ev.agg(F.max("event_id")).first()[0]
    assert O.shuffle_rows(ev, 1).count() == 1000
    assert O.with_partitions(ev, 5).rdd.getNumPartitions() == 5
    assert O.fewer_partitions(O.with_partitions(ev, 5), 1).rdd.getNumPartitions() == 1


def test_rows_per_partition_and_flags(spark):
    o = S.read_table(spark, SF001, "orders").repartition(4)
    per = A.rows_per_partition(o, "o_orderkey")
    assert per.count() == 4 and per.agg(F.sum("rows")).first()[0] == 1500
    assert A.sum_or_zero(o.filter("o_totalprice < 0"), "o_totalprice", "s").first()[0] == 0


def test_bench_helpers_and_job_names(spark):
    build = lambda: S.read_table(spark, SF001, "orders").groupBy("o_orderstatus").count()
    with job_description(spark, "sweep"):
        sweep = partition_sweep(spark, build, counts=(1, 4))
    assert sweep.count() == 2 and spark.sparkContext.getLocalProperty("spark.job.description") is None
    assert aqe_compare(spark, build).count() == 2
    assert schema_string(build()) == "struct<o_orderstatus:string,count:bigint>"


def test_scalar_helpers(spark):
    from tidepool.functions import scalar as X

    df = spark.createDataFrame([(float("nan"), None, "abcdef123456", "2024-01-01T00:00:00.000Z", "file:/a/b/part-00003-uuid-c000.snappy.parquet"),
                                (1.5, "q", "zz", "1970-01-01T00:00:00.000Z", "x/y")],
                               "x double, name string, id string, wm string, path string")
    r = df.select(X.nan_to_null("x").alias("x"), X.label_or_id("name", "id").alias("label"),
                  X.real_watermark("wm").alias("wm"), X.last_path_segment("path").alias("file"),
                  X.short_file_label("path").alias("short"), X.safe_ratio(F.lit(1.0), F.lit(0.0)).alias("ratio"),
                  X.parse_ts(F.lit("not-a-time")).alias("bad")).collect()
    assert r[0]["x"] is None and r[0]["label"] == "unnamed-abcdef12" and r[0]["wm"] is not None
    assert r[0]["file"] == "part-00003-uuid-c000.snappy.parquet" and r[0]["short"] == "part-00003"
    assert r[0]["ratio"] is None and r[0]["bad"] is None
    assert r[1]["x"] == 1.5 and r[1]["label"] == "q" and r[1]["wm"] is None


def test_avro_is_gated(spark, scratch):
    import pytest

    with pytest.raises(RuntimeError, match="Avro"):
        S.read_avro(spark, scratch).count()


def test_publish_lines_is_atomic(scratch):
    from tidepool.streaming.replay import publish_lines

    path = publish_lines(f"{scratch}/land", "a.json", ['{"x": 1}'])
    assert os.path.basename(path) == "a.json"
    assert sorted(os.listdir(f"{scratch}/land")) == ["a.json"]


def test_file_metadata_and_directory_bytes(spark, scratch):
    from tidepool.operators.layout import bytes_per_directory, file_stats

    o = S.read_table(spark, SF001, "orders")
    o.write.partitionBy("o_orderstatus").parquet(f"{scratch}/by_status")
    meta = S.with_file_metadata(spark.read.parquet(f"{scratch}/by_status"))
    assert {"_file_path", "_file_name", "_file_size", "_file_block_start", "_file_mtime"} <= set(meta.columns)
    per_dir = bytes_per_directory(spark, f"{scratch}/by_status").collect()
    assert len(per_dir) == 3 and all(r["bytes"] > 0 for r in per_dir)
    fs = file_stats(spark.read.parquet(f"{scratch}/by_status"), "o_orderkey")
    assert fs.agg(F.sum("rows")).first()[0] == 1500


def test_catalog_listing(spark):
    cats = {r["catalog"] for r in K.catalogs(spark).collect()}
    assert "spark_catalog" in cats


def test_first_n_and_sort(spark):
    o = S.read_table(spark, SF001, "orders")
    top = O.first_n(o, 5, [F.desc("o_totalprice"), F.asc("o_orderkey")]).collect()
    assert len(top) == 5 and top[0]["o_totalprice"] == o.agg(F.max("o_totalprice")).first()[0]
    s = O.sort_by(o.select("o_orderkey"), F.desc("o_orderkey")).first()
    assert s[0] == 1499


def test_approx_percentiles_close_to_exact(spark):
    ev = S.read_table(spark, SF001, "events")
    exact = {r["event_type"]: r["p50"] for r in A.exact_percentiles(ev, ["event_type"], "value", [0.5], ["p50"]).collect()}
    approx = {r["event_type"]: r["p50"] for r in A.approx_percentiles(ev, ["event_type"], "value", [0.5], ["p50"]).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= 0.05 * max(1.0, abs(exact[k])) + 5 for k in exact)


def test_job_tags_cancel(spark):
    import threading
    import time

    from tidepool.plans.inspect import cancel_tagged, job_tag

    errors = []

    def slow():
        try:
            with job_tag(spark, "tp-cancel-me"):
                spark.range(0, 10**10, 1, 200_000).selectExpr("count(*)").collect()  # many short tasks
        except Exception as e:  # noqa: BLE001
            errors.append(str(e))

    t = threading.Thread(target=slow)
    t.start()
    deadline = time.time() + 90
    while t.is_alive() and time.time() < deadline:  # the job may not be submitted yet
        time.sleep(1)
        cancel_tagged(spark, "tp-cancel-me")
    t.join(5)
    assert not t.is_alive() and errors and "cancel" in errors[0].lower()
    assert "tp-cancel-me" not in spark.sparkContext.getJobTags()


def test_replacing_a_table_by_a_query_on_itself(spark):
    from tidepool.sources import catalog as K

    K.create_or_replace(spark.range(10), "self_replace")
    K.create_or_replace(spark.table("self_replace").where("id < 4"), "self_replace")
    assert spark.table("self_replace").count() == 4
    with __import__("pytest").raises(Exception):
        K.create_or_replace(spark.table("self_replace").select((1 / (spark.range(1).id * 0)).alias("x")), "self_replace")
    assert spark.table("self_replace").count() == 4  # a failing write leaves the old table
    K.drop_table(spark, "self_replace")
