"""Versioned table: the documented sequence 20,000 -> 20,005 -> 19,905 -> update -> restore."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.versioned.table import VersionedTable


def users(spark):
    df = (spark.range(20000).select(F.col("id"), F.format_string("user_%06d", "id").alias("name"))
          .withColumn("_f", F.when(F.col("id") < 9084, 0).when(F.col("id") < 17618, 1).otherwise(2)))
    return df.repartitionByRange(3, "_f").drop("_f")


@pytest.fixture(scope="module")
def table(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "users") + "/t", "id")
    t.create(users(spark))
    t.append(spark.range(20000, 20005).select("id", F.format_string("user_%06d", "id").alias("name")), files=1)
    t.delete("id < 100")
    t.update("id < 200", {"name": "concat('vip_', name)"})
    t.restore(0)
    return t


def test_row_counts_by_version(table):
    assert [table.read(v).count() for v in range(5)] == [20000, 20005, 19905, 19905, 20000]
    assert [table.count_from_stats(v) for v in range(5)] == [20000, 20005, 19905, 19905, 20000]


def test_create_has_three_files(table):
    files = table._live(0).orderBy("min_key").select("rows").collect()
    assert [r[0] for r in files] == [9084, 8534, 2382]


def test_delete_copies_one_file(table):
    h = {r["version"]: r for r in table.history().collect()}
    m = h[2]["metrics"]
    assert m["numDeletedRows"] == "100" and m["numCopiedRows"] == "8984" and m["numRemovedFiles"] == "1"
    assert h[1]["isBlindAppend"] is True
    assert h[2]["readVersion"] == 1


def test_update_changes_rows_100_to_199(table):
    changed = table.read(3).filter(F.col("name").startswith("vip_"))
    assert changed.count() == 100
    assert changed.agg(F.min("id"), F.max("id")).first() == (100, 199)


def test_diff(table):
    d12 = table.diff(1, 2)
    assert d12.filter("_change = 'removed'").count() == 100 and d12.filter("_change = 'added'").count() == 0
    d32 = table.diff(3, 2)
    assert d32.filter("_change = 'removed'").count() == 100 and d32.filter("_change = 'added'").count() == 100


def test_restore_equals_version_0(table):
    assert table.read(4).exceptAll(table.read(0)).count() == 0
    assert table.read(0).exceptAll(table.read(4)).count() == 0


def test_history_newest_first(table):
    ops = [r["operation"] for r in table.history().collect()]
    assert ops == ["RESTORE", "UPDATE", "DELETE", "WRITE", "CREATE"]


def test_time_travel_by_timestamp(table):
    ts = {r["version"]: r["ts"] for r in table.history().collect()}
    assert table.version_at(ts[2]) == 2
    assert table.read(timestamp=ts[1]).count() == 20005
    with pytest.raises(ValueError):
        table.version_at(ts[0] - dt.timedelta(days=1))


def test_file_skipping(table):
    live = table._live(0)
    assert live.filter((F.col("max_key") >= 0) & (F.col("min_key") <= 50)).count() == 1
    assert table.read(0, key_range=(0, 50)).count() == 51


def test_compact_and_vacuum(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "compact") + "/t", "id")
    t.create(users(spark))
    for i in range(3):
        t.append(spark.range(20000 + i * 10, 20010 + i * 10).select("id", F.format_string("u%d", "id").alias("name")),
                 files=2)
    before = t.totals().first()
    assert before["live_files"] == 9
    t.compact(target_bytes=10 ** 9)
    after = t.totals().first()
    assert after["live_files"] == 1 and after["live_rows"] == 20030
    assert t.read(t.latest_version() - 1).exceptAll(t.read()).count() == 0
    assert t.history().first()["data_change"] is False
    with pytest.raises(ValueError):
        t.vacuum(retention_hours=1)
    gone = t.vacuum(retention_hours=0, force=True)
    assert gone.filter("deleted").count() == 9
    assert t.read().count() == 20030  # the readability check reads real rows
    with pytest.raises(Exception):
        t.read(0).count()  # files of version 0 are gone


def test_files_and_commit_actions(table):
    files = table.files()
    live = files.filter("live").agg(F.count(F.lit(1)), F.sum("rows")).first()
    assert live[1] == 20000  # after the restore: version 0's three files
    assert files.count() > live[0]  # rewritten and appended files are still on disk
    delete = table.commit_actions(2)
    kinds = {r["action"]: r["n"] for r in delete.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {"commit": 1, "add": 1, "remove": 1}


def test_null_predicate_keeps_row_and_orphans_are_ignored(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "edge") + "/t", "id")
    t.create(spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id long, bal double"))
    t.delete("bal < 0")  # NULL < 0 is NULL: row 2 stays
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]
    # A commit that died after writing data but before its manifest: an orphan folder.
    spark.createDataFrame([(9, 9.0)], "id long, bal double").write.parquet(f"{t.data_dir}/v99-crashed")
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]  # readers never see it
    import os

    crashed = [f for f in os.listdir(f"{t.data_dir}/v99-crashed".replace("file:", "")) if f.endswith(".parquet")]
    orphans = t.files().filter(~F.col("live") & F.col("rows").isNull())
    assert orphans.count() == len(crashed) and orphans.filter(~F.col("file").contains("v99-crashed")).count() == 0
    gone = t.vacuum(retention_hours=0, force=True)
    assert gone.filter(F.col("file").contains("v99-crashed")).filter("deleted").count() == len(crashed)
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]


def test_same_version_cannot_commit_twice(spark):
    from tidepool.session import work_dir

    root = work_dir(spark, "race") + "/t"
    a = VersionedTable(spark, root, "id")
    a.create(spark.range(10))
    b = VersionedTable(spark, root, "id")
    b.latest_version()  # both writers now believe version 0 is the latest
    a.append(spark.range(10, 12))
    with pytest.raises(Exception):
        b.append(spark.range(12, 14))  # version 1 exists already: the second commit fails
    assert VersionedTable(spark, root, "id").read().count() == 12


def test_hot_key_value_is_split_across_files(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "hotkey") + "/t", "k")
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).cast("long").alias("k"),
                                  F.col("id").alias("v"))  # key 0 holds a third of the rows
    t.create(df, files=6)
    rows = sorted(r["rows"] for r in t._live_rows())
    assert len(rows) == 6 and max(rows) < 1000  # key 0 does not land in a single file
    assert t.read().count() == 3000


def test_special_characters_in_the_path(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "odd") + "/a b=c%d", "id")
    t.create(spark.range(100).select("id", (F.col("id") * 2).alias("v")), files=4)
    assert t.count_from_stats() == 100 and t.read(key_range=(0, 9)).count() == 10
    t.delete("id < 10")
    t.update("id < 20", {"v": "0"}, key_range=(15, 30))
    rows = {r["id"]: r["v"] for r in t.read().collect()}
    assert sorted(rows) == list(range(10, 100)) and [i for i, v in rows.items() if v == 0] == [15, 16, 17, 18, 19]
    assert t.read(0).count() == 100


def test_key_range_is_part_of_the_condition(spark):
    from tidepool.session import work_dir

    left = []
    for files in (1, 4):
        t = VersionedTable(spark, work_dir(spark, "range") + "/t", "id")
        t.create(spark.range(100), files=files)
        t.delete("id % 2 = 0", key_range=(10, 20))
        left.append(sorted(r["id"] for r in t.read().collect()))
    assert left[0] == left[1] == [i for i in range(100) if i % 2 or not 10 <= i <= 20]


def test_files_with_only_null_keys(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "nulls") + "/t", "id")
    t.create(spark.createDataFrame([(None, 1), (None, 2)], "id long, v int").coalesce(1))
    t.append(spark.createDataFrame([(5, 3)], "id long, v int"))
    t.delete("v > 0", key_range=(0, 10))
    assert sorted(r["v"] for r in t.read().collect()) == [1, 2]


def test_append_must_fit_the_schema(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "fit") + "/t", "id")
    t.create(spark.createDataFrame([(1, 2)], "id long, v int"))
    for bad in ("id long, v double", "id long, v int, extra int", "id long"):
        with pytest.raises(ValueError):
            t.append(spark.createDataFrame([], bad))
    t.append(spark.createDataFrame([(7, 8)], "v int, id long"))  # any order
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 2), (8, 7)]


def test_unreadable_manifest_is_an_error(spark):
    from tidepool.session import work_dir

    t = VersionedTable(spark, work_dir(spark, "broken") + "/t", "id")
    assert t.latest_version() == -1  # nothing there yet
    spark.createDataFrame([("x",)], "value string").write.text(f"{t.manifest_dir}/version=0")
    with pytest.raises(Exception):
        VersionedTable(spark, t.root, "id").latest_version()


def test_readers_get_folders_of_whole_commits(table):
    assert len(table._paths(table._live(0))) == 1  # three files, one folder
    assert all(not p.endswith(".parquet") for p in table._paths(table._live(1)))
    assert any(p.endswith(".parquet") for p in table._paths(table._live(2)))  # one file of version 0 was rewritten
