"""Joins and skew (properties, plan shape), layout reports, file integrity, reader schema."""

import os
import shutil

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators import joins as J
from tidepool.operators import layout as LY
from tidepool.operators.projection import ReaderField, conform, split_good_bad
from tidepool.plans import batch as B
from tidepool.plans.inspect import exchanges, join_strategies, pushed_filters, read_schemas
from tidepool.sources.tables import read_table

from conftest import SF001


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 3)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_salted_join_equals_plain_join(spark, rows, salts):
    big = spark.createDataFrame(rows + [(0, 9)] * 20, "k long, v long")  # key 0 is hot
    small = spark.createDataFrame([(k, f"l{k}") for k in range(0, 5)], "k long, label string")
    plain = big.join(small, "k")
    for salted in (J.join_salted(big, small, "k", salts=salts),
                   J.join_salted(big, small, "k", max_hot_keys=3, rows_per_salt=2)):
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_hot_keys_bounded(spark):
    li = B.skewed_lineitem(spark, SF001)
    hot = J.hot_keys(li, "join_key", max_hot_keys=5, rows_per_salt=1)
    rows = hot.collect()
    assert 1 <= len(rows) <= 5
    assert rows[0]["join_key"] == 0 and rows[0]["_salts"] > 4000  # no ceiling: one salt per row here


def test_broadcast_only_behind_a_size_check(spark):
    small = spark.range(10)
    assert J.fits_broadcast(small, 10) and not J.fits_broadcast(small, 9)
    over = spark.range(20)
    assert J.maybe_broadcast(over, 5) is over  # over the bound: no hint, Spark decides
    big = spark.range(100).withColumnRenamed("id", "k")
    hinted = J.join_broadcast(big, spark.range(20).withColumnRenamed("id", "k"), "k", max_rows=50)
    assert join_strategies(hinted) == ["BroadcastHashJoin"]


def test_plan_shapes(spark):
    o = read_table(spark, SF001, "orders")
    assert exchanges(o.filter("o_totalprice > 1000")) == 0
    assert exchanges(o.groupBy("o_orderstatus").count()) >= 1
    assert exchanges(o.orderBy("o_totalprice")) >= 1
    assert exchanges(o.dropDuplicates(["o_custkey"])) >= 1
    # Broadcast join: no shuffle of the large side.
    j = B.join_broadcast(spark, SF001)
    assert "BroadcastHashJoin" in join_strategies(j)
    assert "SortMergeJoin" in join_strategies(B.join_plain(spark, SF001))
    # Filters and column pruning reach the scan.
    q = B.count_by_two_keys_one_value(spark, SF001)
    assert any("EqualTo(o_orderstatus,F)" in p for p in pushed_filters(q))
    assert all("o_orderdate" not in s for s in read_schemas(q))


def test_skew_report_share(spark):
    r = B.skew_report(spark, SF001).collect()
    assert r[0]["join_key"] == 0 and r[0]["share"] > 0.85
    assert abs(sum(x["share"] for x in r) - 1.0) < 1e-4


def test_partition_report_keeps_empty_file_and_partition(spark, scratch):
    path = f"{scratch}/t"
    o = read_table(spark, SF001, "orders")
    o.repartition(3).write.parquet(path)
    o.limit(0).write.mode("append").parquet(path)  # a zero-row file
    files, parts, totals = LY.partition_report(spark, path)
    t = totals.first()
    assert t["total_rows"] == t["partition_rows"] == 1500
    assert files.filter("rows = 0").count() >= 1
    assert parts.agg(F.sum("rows")).first()[0] == 1500


def test_split_audit_finds_gaps_and_overlaps(spark, scratch):
    """Splits of many files, row by row; then the same table of splits with one left out and one doubled."""
    from tidepool.sources.tables import read_split

    path = f"{scratch}/many"
    spark.range(6000).select("id", F.repeat(F.lit("x"), 20).alias("t")).repartition(5).write.json(path)
    splits = LY.split_audit(read_split(spark, path, 8000, "json", "id long, t string"), "id").persist()
    assert splits.count() > 15 and splits.agg(F.sum("rows")).first()[0] == 6000
    cover = LY.split_coverage(splits, slack=64).collect()
    assert len(cover) == 5 and {(r.gap_bytes, r.overlap_bytes) for r in cover} == {(0, 0)}
    per_file = {r.file_uri: r.n for r in spark.read.json(path).groupBy(F.col("_metadata.file_path").alias("file_uri")).agg(F.count("*").alias("n")).collect()}
    assert {r.file_uri: r["rows"] for r in cover} == per_file
    one = splits.where("block_start > 0").orderBy("file_uri", "block_start").first()
    hole = splits.where((F.col("file_uri") != one.file_uri) | (F.col("block_start") != one.block_start))
    assert [r.gap_bytes for r in LY.split_coverage(hole, slack=64).collect() if r.file_uri == one.file_uri] == [one.block_length]
    twice = splits.unionByName(spark.createDataFrame([one], splits.schema))
    assert [r.overlap_bytes for r in LY.split_coverage(twice, slack=64).collect() if r.file_uri == one.file_uri] == [one.block_length]
    cut = splits.withColumn("block_length", F.when(F.col("block_start") == 0, F.col("block_length") - 100).otherwise(F.col("block_length")))
    assert {r.gap_bytes for r in LY.split_coverage(cut, slack=64).collect()} == {100}
    splits.unpersist()


def test_split_audit_of_parquet_and_nothing(spark, scratch):
    o = read_table(spark, SF001, "orders")
    splits = LY.split_audit(o, "o_orderkey")
    assert splits.agg(F.sum("rows")).first()[0] == 1500
    assert LY.split_coverage(splits).first().gap_bytes == 0
    assert LY.split_coverage(splits.limit(0)).collect() == []


def test_file_integrity_detects_one_flipped_byte(spark, scratch):
    good = f"{scratch}/good"
    read_table(spark, SF001, "orders").repartition(2).write.parquet(good)
    ok = LY.file_integrity(spark, good).collect()
    assert len(ok) == 2 and all(r["has_sidecar"] and r["bad_chunks"] == 0 for r in ok)
    bad = f"{scratch}/bad"
    shutil.copytree(good, bad)
    victim = sorted(f for f in os.listdir(bad) if f.endswith(".parquet"))[0]
    with open(os.path.join(bad, victim), "r+b") as f:
        f.seek(700)
        b = f.read(1)
        f.seek(700)
        f.write(bytes([b[0] ^ 0xFF]))
    rows = {r["file_name"]: r["bad_chunks"] for r in LY.file_integrity(spark, bad).collect()}
    assert rows[victim] == 1 and sum(rows.values()) == 1


def test_conform_reader_schema(spark):
    p = read_table(spark, SF001, "part")
    out = conform(p, B.PART_READER)
    assert out.columns == ["part_key", "title", "brand", "size", "retail_price", "currency"]
    assert out.filter("currency = 'USD'").count() == p.count()
    nulls = spark.createDataFrame([(1, None)], "p_partkey long, p_size int")
    r = conform(nulls, [ReaderField("k", "bigint", ("p_partkey",)), ReaderField("size", "int", ("p_size",), 0, False),
                        ReaderField("note", "string")]).first()
    assert (r["k"], r["size"], r["note"]) == (1, 0, None)


def test_good_bad_split_is_a_partition(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    good, bad = split_good_bad(df, F.col("x") > 0)
    assert good.count() == 1 and bad.count() == 2


@pytest.mark.parametrize("n", [1, 3])
def test_latest_per_key_defined_survivor(spark, n):
    from tidepool.operators.aggregate import latest_per_key

    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, "q")] * n, "k int, t int, p string")
    rows = {r["k"]: (r["t"], r["p"]) for r in latest_per_key(df, ["k"], ["t"], ["p"]).collect()}
    assert rows == {1: (5, "b"), 2: (1, "q")}


def test_salting_spreads_the_hot_key_over_tasks(spark):
    big = B.skewed_lineitem(spark, SF001)  # 90 % of rows on key 0
    hot = J.hot_keys(big, "join_key", rows_per_salt=200)
    salted, _ = J.salted_sides(big, J.key_lookup(spark, 100), "join_key", hot)

    def max_share(df, *cols):
        parts = df.repartition(16, *cols).groupBy(F.spark_partition_id().alias("p")).count()
        return parts.agg(F.max("count")).first()[0] / df.count()

    assert max_share(big, "join_key") > 0.85  # one task would get the hot key
    assert max_share(salted, "join_key", "_salt") < 0.25  # spread over the tasks


def test_hot_group_aggregates_partially_before_the_shuffle(spark):
    from tidepool.operators.aggregate import latest_per_key
    from tidepool.plans.inspect import plan_text

    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("t"))  # key 0 holds a third of the rows
    out = latest_per_key(df, ["k"], ["t"])
    import re

    ops = re.findall(r"^\(\d+\) (\w+)", plan_text(out), flags=re.M)  # leaves first
    ex = ops.index("Exchange")
    # A partial aggregate runs before the exchange and the final one after it: the hot key
    # crosses the shuffle as one row per map task, not as a third of the table.
    assert any(o.endswith("Aggregate") for o in ops[:ex]) and any(o.endswith("Aggregate") for o in ops[ex:])
    assert out.filter("k = 0").first()["t"] == 29997


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))),
                min_size=1, max_size=80))
def test_ranked_percentiles_equal_builtin(spark, rows):
    from tidepool.operators.aggregate import exact_percentiles, ranked_percentiles

    rows = rows + [("a", 7)] * 30 + [("only nulls", None)] * 3  # "a" is hot
    df = spark.createDataFrame(rows, "g string, v int")
    ps, names = [0.0, 0.25, 0.5, 0.9, 1.0], ["p0", "p25", "p50", "p90", "p100"]
    got = {r["g"]: tuple(r) for r in ranked_percentiles(df, ["g"], "v", ps, names, partitions=4).collect()}
    want = {r["g"]: tuple(r) for r in exact_percentiles(df, ["g"], "v", ps, names).collect()}
    assert got == want and got["only nulls"][1] == 3
    whole = ranked_percentiles(df, [], "v", ps, names).first()
    assert tuple(whole)[1:] == tuple(exact_percentiles(df, [], "v", ps, names).first())[1:] and whole["n"] == len(rows)


def test_hot_values_and_large_groups_are_spread(spark):
    from tidepool.operators.aggregate import rank_values
    from tidepool.plans.inspect import plan_text

    hot_value = spark.range(90000).select(F.lit("hot").alias("g"), F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("v"))
    r = rank_values(hot_value, ["g"], "v", partitions=8)
    text = plan_text(r, "simple")
    assert "rangepartitioning" in text and "partial_count" in text  # a hot value is one row before the ranges
    per_range = [x["count"] for x in r.groupBy("_pid").count().collect()]
    assert sum(per_range) == 9001 and len(per_range) > 4 and max(per_range) < 9001 / 3


def test_narrow_equal_rows_fill_all_salts(spark):
    big = spark.range(5000).select(F.lit(0).alias("k"))  # one column, all rows equal
    salted, _ = J.salted_sides(big, spark.createDataFrame([(0, "x")], "k int, label string"), "k", salts=16)
    counts = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(counts) == 16 and max(counts) < 2 * min(counts)


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10000).alias("t"))
    assert J.fits_broadcast(wide, 1000) and not J.fits_broadcast(wide, 1000, max_bytes=100_000)


def test_paths_with_special_characters(spark, scratch):
    path = f"{scratch}/a b=c%d+e/t"
    o = read_table(spark, SF001, "orders")
    o.repartition(2).write.parquet(path)
    o.repartition(1).write.mode("append").parquet(path)
    files, parts, totals = LY.partition_report(spark, path)
    assert totals.first()["total_rows"] == totals.first()["partition_rows"] == 3000
    assert files.where("rows = 0").count() == 0
    read = {f for r in parts.collect() for f in r["files_read"]}
    assert read == {r["file_path"] for r in files.collect()} and len(read) == 3  # whole names, none merged


def test_conform_requires_required_fields(spark):
    df = spark.createDataFrame([(None, 2), (3, None)], "old int, new int")
    r = conform(df, [ReaderField("new", "int", ("old",))]).collect()
    assert [x["new"] for x in r] == [2, 3]  # names are coalesced, not just the first one taken
    with pytest.raises(ValueError, match="missing"):
        conform(df, [ReaderField("other", "int", nullable=False)])
    with pytest.raises(Exception, match="required field"):
        conform(df, [ReaderField("new", "int", nullable=False)]).collect()


def test_skew_join_settings_stay_in_their_session(spark):
    own = spark.newSession()
    J.skew_join_settings(own, factor=2.0, threshold="1MB")
    assert own.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "2.0"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") != "2.0"
