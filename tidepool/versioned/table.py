"""A versioned table on plain Parquet files plus a manifest.

Layout under `root`:

    data/v<version>-<id>/part-*.parquet       data files, one folder per commit
    _manifest/version=<n>/part-*.parquet       the actions of commit n

A commit's manifest rows say which files it added and removed (with rows, bytes and the
min/max of the key column per file), plus one `commit` row with the operation, its
parameters and metrics.  The live files of version N are the files added at or before N
and not removed at or before N.  Both the data and the manifest are written by Spark's
own committer, so a commit is visible only once its manifest folder is complete; data
folders of a commit that never finished are ignored by readers and removed by `vacuum`.
One writer at a time (no transaction protocol).

All the data work -- file statistics, finding the files a predicate touches, rewriting
them, counting, diffs -- is Spark jobs.  Readers are given whole commit folders, and single
files only of commits that were partly rewritten.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import folder, work_dir

MIN_RETENTION_HOURS = 168  # vacuum refuses a shorter retention unless forced


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self.manifest_dir = f"{self.root}/_manifest"
        self.data_dir = f"{self.root}/data"
        self._latest: int | None = None  # single writer: the version this object last saw or wrote
        self._key_type: T.DataType | None = None
        # Live files of `_latest`, kept after each commit this object writes.  If another
        # writer committed meanwhile, our next commit fails on the existing version folder.
        self._live_cache: dict[str, dict] | None = None

    # ----------------------------------------------------------------- manifest
    def _manifest_schema(self, key_type: T.DataType) -> T.StructType:
        m = T.MapType(T.StringType(), T.StringType())
        return T.StructType([
            T.StructField("ts", T.TimestampType()),
            T.StructField("operation", T.StringType()),
            T.StructField("params", m),
            T.StructField("metrics", m),
            T.StructField("action", T.StringType()),
            T.StructField("file", T.StringType()),
            T.StructField("uri", T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("bytes", T.LongType()),
            T.StructField("min_key", key_type),
            T.StructField("max_key", key_type),
            T.StructField("data_change", T.BooleanType()),
        ])

    def manifest(self) -> DataFrame:
        """Every action of every committed version (V13 filters it by version)."""
        return self.spark.read.parquet(self.manifest_dir)

    def latest_version(self) -> int:
        """-1 where nothing was ever committed; a manifest that cannot be read is an error."""
        if self._latest is None:
            fs, path = folder(self.spark, self.manifest_dir)
            self._latest = int(self.manifest().agg(F.max("version")).first()[0]) if fs.exists(path) else -1
        return self._latest

    def _live(self, version: int | None = None) -> DataFrame:
        """Live file rows (file, rows, bytes, min_key, max_key) of a version."""
        m = self.manifest()
        if version is not None:
            m = m.filter(F.col("version") <= version)
        files = m.filter(F.col("action").isin("add", "remove"))
        last = files.groupBy("file").agg(F.max_by(F.struct("action", "uri", "rows", "bytes", "min_key", "max_key"),
                                                  F.col("version")).alias("s"))
        return last.filter(F.col("s.action") == "add").select(
            "file", "s.uri", "s.rows", "s.bytes", "s.min_key", "s.max_key")

    def _live_rows(self, version: int | None = None) -> list[dict]:
        """The live file list as rows (one per file: commit metadata, bounded by file count)."""
        if (version is None or version == self._latest) and self._live_cache is not None:
            return list(self._live_cache.values())
        rows = [r.asDict() for r in self._live(version).collect()]
        if version is None:
            self._live_cache = {r["file"]: r for r in rows}
        return rows

    def _schema(self):
        """The table's schema, from one data file it ever added (all share one schema)."""
        first = self.manifest().filter(F.col("action") == "add").select("file").limit(1).collect()
        return self.spark.read.parquet(first[0][0]).schema

    def _paths(self, live: DataFrame) -> list[str]:
        """What to read for the live files: a commit's folder where all its files are live, and single
        files only of commits that a rewrite has partly replaced.  So the driver's list follows the
        number of commits and of rewritten files, not the size of the table."""
        added = self.manifest().where("action = 'add'").select("file").distinct()
        parent = F.regexp_extract("file", r"^(.*)/[^/]*$", 1)
        both = added.join(live.select("file", F.lit(True).alias("live")), "file", "left").withColumn("folder", parent)
        whole = both.groupBy("folder").agg(F.count("*").alias("files"), F.count("live").alias("live"))
        whole = whole.where("live > 0").withColumn("whole", F.col("files") == F.col("live"))
        paths = [r.folder for r in whole.where("whole").select("folder").collect()]
        parts = both.where("live").join(whole.where("NOT whole").select("folder"), "folder", "left_semi")
        return sorted(paths) + sorted(r.file for r in parts.select("file").collect())

    # ----------------------------------------------------------------- writing
    def _write_files(self, df: DataFrame, version: int, files: int | None = None) -> list[dict]:
        """Write `df` as new data files; return their stats, one row per file.

        Every file the write produced is listed (zero-row files included, so the manifest
        accounts for all of them); rows and key min/max come from reading the new files
        back (key column and footers only).
        """
        from tidepool.operators.layout import list_files

        to = f"{self.data_dir}/v{version}-{uuid.uuid4().hex[:8]}"
        out = df.repartition(files) if files else df
        out.write.mode("errorifexists").parquet(to)
        if self._key_type is None:
            self._key_type = out.schema[self.key].dataType
        back = self.spark.read.parquet(to)
        stats = (back.groupBy(F.col("_metadata.file_path").alias("uri"))
                 .agg(F.count(F.lit(1)).alias("rows"), F.min(self.key).alias("min_key"),
                      F.max(self.key).alias("max_key")))
        listed = list_files(self.spark, to, recursive=False).select(
            F.col("file_path").alias("file"), F.col("file_uri").alias("uri"), F.col("file_bytes").alias("bytes"))
        both = listed.join(stats, "uri", "full_outer").select(
            "file", "uri", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), "min_key", "max_key")
        files = [r.asDict() for r in both.collect()]
        if any(f["file"] is None for f in files):
            raise RuntimeError(f"files of {to} hold rows but are not listed")
        return files

    def _key_type_now(self) -> T.DataType:
        if self._key_type is None:
            self._key_type = self.manifest().schema["min_key"].dataType
        return self._key_type

    def _commit(self, version: int, operation: str, params: Mapping[str, object], metrics: Mapping[str, object],
                adds: list[dict], removes: list[dict], data_change: bool = True) -> int:
        """Write the manifest folder of one version: a commit row plus one row per file
        added or removed.  Spark's job commit makes the folder appear whole or not at all."""
        schema = self._manifest_schema(self._key_type_now())
        now = dt.datetime.now(dt.timezone.utc)
        empty: dict[str, str] = {}
        rows = [(now, operation, {k: str(v) for k, v in params.items()}, {k: str(v) for k, v in metrics.items()},
                 "commit", None, None, None, None, None, None, data_change)]
        for action, files in (("add", adds), ("remove", removes)):
            rows += [(now, operation, empty, empty, action, f["file"], f["uri"], f["rows"], f["bytes"], f["min_key"],
                      f["max_key"], data_change) for f in files]
        before = self._live_rows() if version > 0 else []
        (self.spark.createDataFrame(rows, schema).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.manifest_dir}/version={version}"))
        live = {f["file"]: f for f in before}
        for f in removes:
            live.pop(f["file"], None)
        for f in adds:
            live[f["file"]] = {k: f[k] for k in ("file", "uri", "rows", "bytes", "min_key", "max_key")}
        self._latest, self._live_cache = version, live
        return version

    # ----------------------------------------------------------------- operations
    def _by_key_range(self, df: DataFrame, n: int) -> DataFrame:
        """Range-partition into `n` files ordered by key (tight min/max for file skipping).

        A deterministic hash of the row is the second range key, so rows sharing one hot
        key value can still be split over several files instead of one task writing them all.
        """
        return df.repartitionByRange(n, F.col(self.key), F.xxhash64(*[F.col(c) for c in df.columns]))

    def create(self, df: DataFrame, files: int | None = None) -> int:
        """V1: version 0 from a DataFrame (optionally range-partitioned into `files`)."""
        src = self._by_key_range(df, files) if files else df
        adds = self._write_files(src, 0)
        return self._commit(0, "CREATE", {"mode": "ErrorIfExists"},
                            {"numFiles": len(adds), "numOutputRows": sum(f["rows"] for f in adds)}, adds, [])

    def append(self, df: DataFrame, files: int | None = None) -> int:
        """V2: blind append: new files only.  Names and types must be those of the table (in any order)."""
        v = self.latest_version() + 1
        want = {f.name: f.dataType for f in self._schema().fields}
        have = {f.name: f.dataType for f in df.schema.fields}
        if want != have:
            odd = sorted(k for k in {*want, *have} if want.get(k) != have.get(k))
            raise ValueError(f"append does not fit the table's schema in {odd}: {[(k, want.get(k), have.get(k)) for k in odd]}")
        df = df.select(*want)
        adds = self._write_files(df, v, files)
        return self._commit(v, "WRITE", {"mode": "Append", "readVersion": v - 1, "isBlindAppend": True},
                            {"numFiles": len(adds), "numOutputRows": sum(f["rows"] for f in adds)}, adds, [])

    def _condition(self, cond: Column | str, key_range: tuple | None) -> Column:
        cond = F.expr(cond) if isinstance(cond, str) else cond
        return cond if key_range is None else cond & F.col(self.key).between(*key_range)

    def _touched(self, cond: Column, key_range: tuple | None) -> list[dict]:
        """Live files holding at least one row where `cond` is true, with `matched` rows each: one scan.
        Files without rows, and with `key_range` those whose keys (NULL in all rows, or outside it)
        cannot match, are not read."""
        live = {f["uri"]: f for f in self._live_rows() if f["rows"]}
        if key_range is not None:
            lo, hi = key_range
            live = {u: f for u, f in live.items() if f["max_key"] is not None and f["max_key"] >= lo and f["min_key"] <= hi}
        if not live:
            return []
        hits = (self.spark.read.parquet(*[f["file"] for f in live.values()]).filter(F.coalesce(cond, F.lit(False)))
                .groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count(F.lit(1)).alias("matched")))
        return [{**live[r["uri"]], "matched": r["matched"]} for r in hits.collect()]  # one row per touched file

    def delete(self, cond: Column | str, key_range: tuple | None = None) -> int:
        """V3: copy-on-write delete; only files with a matching row are rewritten.

        A row whose predicate is NULL is kept (SQL DELETE semantics).  A `key_range` is part of the
        predicate (and prunes files by it), so the result never depends on the file layout.
        """
        cond = self._condition(cond, key_range)
        v = self.latest_version() + 1
        touched = self._touched(cond, key_range)
        adds = []
        if touched:
            kept = self.spark.read.parquet(*[f["file"] for f in touched]).filter(~F.coalesce(cond, F.lit(False)))
            adds = self._write_files(kept, v)
        metrics = {"numDeletedRows": sum(f["matched"] for f in touched), "numCopiedRows": sum(f["rows"] for f in adds),
                   "numRemovedFiles": len(touched), "numAddedFiles": len(adds)}
        return self._commit(v, "DELETE", {"predicate": str(cond), "readVersion": v - 1}, metrics, adds, touched)

    def update(self, cond: Column | str, assignments: Mapping[str, Column | str],
               key_range: tuple | None = None) -> int:
        """V4: copy-on-write update of the files with a matching row (`key_range` as in `delete`)."""
        cond = self._condition(cond, key_range)
        sets = {k: (F.expr(e) if isinstance(e, str) else e) for k, e in assignments.items()}
        v = self.latest_version() + 1
        touched = self._touched(cond, key_range)
        adds = []
        if touched:
            hit = F.coalesce(cond, F.lit(False))
            old = self.spark.read.parquet(*[f["file"] for f in touched])
            new = old.select(*[(F.when(hit, sets[c]).otherwise(F.col(c)).cast(old.schema[c].dataType).alias(c))
                               if c in sets else F.col(c) for c in old.columns])
            adds = self._write_files(new, v)
        n_upd = sum(f["matched"] for f in touched)
        metrics = {"numUpdatedRows": n_upd, "numCopiedRows": sum(f["rows"] for f in adds) - n_upd,
                   "numRemovedFiles": len(touched), "numAddedFiles": len(adds)}
        return self._commit(v, "UPDATE", {"predicate": str(cond), "readVersion": v - 1}, metrics, adds, touched)

    def restore(self, version: int) -> int:
        """V9: make the live files equal to those of `version`, as a new commit (history kept)."""
        v = self.latest_version() + 1
        now_live = {f["file"]: f for f in self._live_rows()}
        then_live = {f["file"]: f for f in self._live_rows(version)}
        adds = [f for k, f in then_live.items() if k not in now_live]
        removes = [f for k, f in now_live.items() if k not in then_live]
        return self._commit(v, "RESTORE", {"version": version, "readVersion": v - 1},
                            {"numRestoredFiles": len(adds), "numRemovedFiles": len(removes),
                             "restoredFilesSize": sum(f["bytes"] for f in adds),
                             "removedFilesSize": sum(f["bytes"] for f in removes)}, adds, removes)

    def compact(self, target_bytes: int = 128 * 1024 * 1024, min_files: int = 2) -> int:
        """Rewrite the small live files into about total/target files; same rows.

        Only files smaller than `target_bytes` take part, so a compacted table is not
        rewritten again.  `data_change=false`: readers of any version see the same rows.
        """
        v = self.latest_version() + 1
        small = [f for f in self._live_rows() if f["bytes"] < target_bytes]
        params = {"targetBytes": target_bytes, "readVersion": v - 1}
        if len(small) < min_files:
            return self._commit(v, "OPTIMIZE", params, {"numRemovedFiles": 0, "numAddedFiles": 0}, [], [],
                                data_change=False)
        n_out = max(1, -(-sum(f["bytes"] for f in small) // target_bytes))
        rows = self.spark.read.parquet(*[f["file"] for f in small])
        rows = self._by_key_range(rows, n_out) if n_out > 1 else rows.coalesce(1)
        adds = self._write_files(rows, v)
        return self._commit(v, "OPTIMIZE", params, {"numRemovedFiles": len(small), "numAddedFiles": len(adds)},
                            adds, small, data_change=False)

    # ----------------------------------------------------------------- reading
    def version_at(self, timestamp) -> int:
        """V7: the latest version committed at or before `timestamp`."""
        v = (self.manifest().filter((F.col("action") == "commit") & (F.col("ts") <= F.lit(timestamp)))
             .agg(F.max("version")).first()[0])
        if v is None:
            raise ValueError(f"no version committed at or before {timestamp}")
        return int(v)

    def read(self, version: int | None = None, timestamp=None, key_range: tuple | None = None) -> DataFrame:
        """Rows of a version; with `key_range`, files outside it are skipped."""
        if timestamp is not None:
            version = self.version_at(timestamp)
        live = self._live(version)
        if key_range is not None:
            lo, hi = key_range
            live = live.filter((F.col("max_key") >= lo) & (F.col("min_key") <= hi))
        paths = self._paths(live)
        df = self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())
        if key_range is not None:
            df = df.filter(F.col(self.key).between(*key_range))
        return df

    def _read_files(self, live: DataFrame) -> DataFrame:
        paths = self._paths(live)
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())

    def diff(self, a: int, b: int) -> DataFrame:
        """V8: rows of version a missing from b ('removed') and rows of b missing from a ('added').

        Files live in both versions hold the same rows and cancel out, so only the files
        that differ between the two versions are read and compared (a delete that touched
        one file of a thousand compares that one file with its rewrite).
        """
        la, lb = self._live(a), self._live(b)
        only_a = self._read_files(la.join(lb.select("file"), "file", "left_anti"))
        only_b = self._read_files(lb.join(la.select("file"), "file", "left_anti"))
        return (only_a.exceptAll(only_b).withColumn("_change", F.lit("removed"))
                .unionByName(only_b.exceptAll(only_a).withColumn("_change", F.lit("added"))))

    def history(self) -> DataFrame:
        """V5: one row per version, newest first."""
        c = self.manifest().filter(F.col("action") == "commit")
        return (c.select("version", "ts", "operation", "params", "metrics", "data_change",
                         F.col("params")["readVersion"].cast("long").alias("readVersion"),
                         F.coalesce(F.col("params")["isBlindAppend"] == "True", F.lit(False)).alias("isBlindAppend"))
                .orderBy(F.desc("version")))

    def commit_actions(self, version: int) -> DataFrame:
        """The actions of one version."""
        return self.manifest().filter(F.col("version") == version).orderBy("action", "file")

    def files(self) -> DataFrame:
        """Every data file on disk, with rows and bytes, and whether it is live now."""
        from tidepool.operators.layout import list_files

        live = self._live().select("file", F.lit(True).alias("live"))
        known = (self.manifest().filter(F.col("action") == "add")
                 .groupBy("file").agg(F.max("rows").alias("rows")))
        disk = list_files(self.spark, self.data_dir).select(F.col("file_path").alias("file"), "file_bytes", "mtime")
        return (disk.join(known, "file", "left").join(live, "file", "left")
                .select("file", "file_bytes", "rows", "mtime", F.coalesce("live", F.lit(False)).alias("live")))

    def count_from_stats(self, version: int | None = None) -> int:
        """Row count answered from the manifest, no data read."""
        return int(self._live(version).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])

    def totals(self, version: int | None = None) -> DataFrame:
        """Live files and bytes."""
        return self._live(version).agg(F.count(F.lit(1)).alias("live_files"),
                                       F.coalesce(F.sum("bytes"), F.lit(0)).alias("live_bytes"),
                                       F.coalesce(F.sum("rows"), F.lit(0)).alias("live_rows"))

    def vacuum(self, retention_hours: float = MIN_RETENTION_HOURS, force: bool = False, now=None,
               dry_run: bool = False) -> DataFrame:
        """Delete data files not live now and untouched for `retention_hours`.

        Files are deleted by the executors (one task per group of files), not the driver.
        Returns the deleted (or, with dry_run, deletable) files.
        """
        if retention_hours < MIN_RETENTION_HOURS and not force:
            raise ValueError(f"retention {retention_hours} h is below {MIN_RETENTION_HOURS} h; pass force=True")
        now = now or dt.datetime.now(dt.timezone.utc)
        cutoff = now - dt.timedelta(hours=retention_hours)
        removed_at = (self.manifest().filter(F.col("action") == "remove")
                      .groupBy("file").agg(F.max("ts").alias("removed_ts")))
        cand = (self.files().filter(~F.col("live")).join(removed_at, "file", "left")
                .withColumn("since", F.coalesce("removed_ts", F.col("mtime")))
                .filter(F.col("since") <= F.lit(cutoff).cast("timestamp"))
                .select("file", "file_bytes"))
        if dry_run:
            return cand
        # Run the deletes now, exactly once, and keep what was done as a small report:
        # a lazy DataFrame with side effects would delete again on every action.
        report = f"{self.root}/_vacuum/{now.strftime('%Y%m%dT%H%M%S%f')}"
        (cand.mapInPandas(_delete_files, "file string, file_bytes long, deleted boolean")
         .write.mode("errorifexists").parquet(report))
        return self.spark.read.parquet(report)


def _delete_files(batches):
    import pandas as pd
    from pyarrow import fs as pafs

    for pdf in batches:
        done = []
        for f in pdf["file"]:
            # A retried task finds some files already gone: that counts as deleted, so the
            # report is the same however often a task runs.
            try:
                filesystem, path = pafs.FileSystem.from_uri(f if "://" in f else "file://" + f.replace("file:", ""))
                filesystem.delete_file(path)
                done.append(True)
            except FileNotFoundError:
                done.append(True)
            except OSError:
                done.append(False)
        yield pd.DataFrame({"file": pdf["file"], "file_bytes": pdf["file_bytes"], "deleted": done})


def new_table_root(spark: SparkSession, name: str) -> str:
    return os.path.join(work_dir(spark, name), "table")
