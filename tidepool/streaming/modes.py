"""The complete and update output modes, for sinks that are folders of Parquet files.

File sinks accept append only, so both modes go through `foreachBatch`.  Complete mode writes the
whole result it is handed into a snapshot folder `batch=<id>`; readers take the newest one that is
complete (it has `_SUCCESS`), and the two newest are kept.  Update mode is handed the rows that
changed and upserts them into a target divided into hash buckets, so a small batch rewrites only the
buckets that its keys fall into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import ensure_folder, folder

KEPT_SNAPSHOTS = 2
BUCKETS = 64
BUCKET, BATCH = "_bucket", "_batch"


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Rows per key since the stream began (an aggregation without a watermark)."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def snapshots(spark: SparkSession, target_dir: str) -> list[int]:
    """Batch ids of the complete snapshots, oldest first (a few folder names)."""
    fs, root = folder(spark, target_dir)
    if not fs.exists(root):
        return []
    names = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("batch=")]
    jvm = spark.sparkContext._jvm
    return sorted(int(p.getName()[6:]) for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def latest_snapshot(spark: SparkSession, target_dir: str, before: int | None = None) -> DataFrame | None:
    """The newest complete snapshot (of a batch before `before`), or None."""
    ids = [b for b in snapshots(spark, target_dir) if before is None or b < before]
    return spark.read.parquet(f"{target_dir}/batch={ids[-1]}") if ids else None


def drain_complete(df: DataFrame, target_dir: str, checkpoint_dir: str, name: str = "complete") -> None:
    """Complete mode: every micro-batch is the whole result."""
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target_dir}/batch={batch_id}")
        fs, _ = folder(spark, target_dir)
        for old in snapshots(spark, target_dir)[:-KEPT_SNAPSHOTS]:
            fs.delete(folder(spark, f"{target_dir}/batch={old}")[1], True)

    q = (df.writeStream.outputMode("complete").foreachBatch(write).queryName(name)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")


def drain_update(df: DataFrame, target_dir: str, checkpoint_dir: str, keys: Sequence[str], name: str = "update",
                 buckets: int = BUCKETS) -> None:
    """Update mode: the changed rows of a micro-batch replace those of the same keys.

    The target is divided by a hash of the keys into `buckets` folders, and a batch reads and writes
    only the buckets that its keys fall into (`bucket=<b>/batch=<id>`, dynamic partition overwrite, so
    a batch that runs again replaces its own folders and nothing else).  A marker written afterwards
    makes the batch visible; readers take the newest visible folder of each bucket (`read_buckets`), so
    an interrupted batch never hides rows.  Each bucket keeps the two newest."""
    spark = df.sparkSession
    keys = list(keys)
    made = _names(spark, target_dir, "buckets=")
    if made and made != [buckets]:
        raise ValueError(f"{target_dir} has {made[0]} buckets, not {buckets}")
    ensure_folder(spark, f"{target_dir}/buckets={buckets}")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most `buckets`
            held = [b for b in _visible(spark, target_dir, before=batch_id) if b[0] in set(touched)]
            out = rows
            if held:
                new = rows.select(BUCKET, *[F.col(k).alias(f"_new_{k}") for k in keys])
                before = _folders(spark, target_dir, held)
                same = [before[BUCKET] == new[BUCKET], *[F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]]
                out = before.join(new, same, "left_anti").unionByName(rows)
            (out.withColumn(BATCH, F.lit(batch_id)).repartition(BUCKET).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(f"{target_dir}/data"))
        finally:
            rows.unpersist()
        ensure_folder(spark, f"{target_dir}/visible/{batch_id}")
        fs, _ = folder(spark, target_dir)
        for b, ids in _batches(spark, target_dir, touched).items():
            seen = [i for i in ids if i <= batch_id]
            for old in seen[:-KEPT_SNAPSHOTS]:
                fs.delete(folder(spark, f"{target_dir}/data/{BUCKET}={b}/{BATCH}={old}")[1], True)

    q = (df.writeStream.outputMode("update").foreachBatch(write).queryName(name)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")


def _names(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the folders `<prefix><number>` of a folder, ascending."""
    fs, root = folder(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def _batches(spark: SparkSession, target_dir: str, buckets: Sequence[int] | None = None) -> dict[int, list[int]]:
    """The batches that wrote each bucket (folder names: the number of buckets times the kept batches)."""
    root = f"{target_dir}/data"
    found = _names(spark, root, f"{BUCKET}=") if buckets is None else buckets
    return {b: _names(spark, f"{root}/{BUCKET}={b}", f"{BATCH}=") for b in found}


def _visible(spark: SparkSession, target_dir: str, before: int | None = None) -> list[tuple[int, int]]:
    """(bucket, its newest visible batch), of batches before `before`."""
    shown = {i for i in _names(spark, f"{target_dir}/visible", "") if before is None or i < before}
    newest = {b: max((i for i in ids if i in shown), default=None) for b, ids in _batches(spark, target_dir).items()}
    return [(b, i) for b, i in newest.items() if i is not None]


def _folders(spark: SparkSession, target_dir: str, held: Sequence[tuple[int, int]]) -> DataFrame:
    root = f"{target_dir}/data"
    return spark.read.option("basePath", root).parquet(*[f"{root}/{BUCKET}={b}/{BATCH}={i}" for b, i in held]).drop(BATCH)


def read_buckets(spark: SparkSession, target_dir: str) -> DataFrame | None:
    """The table that update-mode batches were upserted into, or None before the first."""
    held = _visible(spark, target_dir)
    return _folders(spark, target_dir, held).drop(BUCKET) if held else None
