"""Idempotent "insert when not matched" of each micro-batch into a Parquet table.

A row is identified by its key columns, of which the time column is one (a device and the time of
its reading, say); keys are compared null-safely.  The target is partitioned by the date of the
time column.  Per batch: duplicates inside the batch are dropped, rows whose key the target holds
are dropped by an anti-join that reads only the dates, times and key ranges the batch spans (any match
has the same time and keys, so nothing outside can match), and the rest is appended.  Rows without a time have no
identity; they go to `<target>_quarantine`, in a folder per batch that a replay overwrites.
A replayed batch, a redelivered file or a restarted query inserts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import ensure_folder

DATE_COL = "_date"
ROWS_PER_FILE = 1_000_000


def quarantine_dir(target_dir: str) -> str:
    return f"{target_dir.rstrip('/')}_quarantine"


def key_ranges(batch: DataFrame, keys: Sequence[str]) -> Column:
    """The condition that every row equal to one of the batch in `keys` fulfils: each whole-number, text
    or date key lies between the batch's least and greatest value, or is NULL where the batch has a NULL."""
    ranged = [k for k in keys if isinstance(batch.schema[k].dataType, (T.IntegralType, T.StringType, T.DateType))]
    found = batch.agg(F.count(F.lit(1)), *[f(k) for k in ranged for f in (F.min, F.max, F.count)]).first()
    inside = F.lit(True)
    for i, k in enumerate(ranged):
        lo, hi, n = found[1 + 3 * i:4 + 3 * i]
        here = F.col(k).between(lo, hi) if n else F.lit(False)
        inside = inside & (here if n == found[0] else here | F.col(k).isNull())
    return inside


def insert_new(target_dir: str, keys: Sequence[str], ts_col: str, rows_per_file: int = ROWS_PER_FILE):
    """A foreachBatch function appending only rows whose key the target lacks.  The tasks that write a
    date follow its rows: one for every `rows_per_file` rows of the batch's largest date."""
    keys = list(keys)
    if ts_col not in keys:
        raise ValueError(f"the time column {ts_col!r} must be one of the key columns {keys}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = batch.withColumn(DATE_COL, F.to_date(ts_col)).dropDuplicates(keys).persist()
        try:
            # Bounds computed by Spark (dates in the session time zone, like the partitions).
            by_date = b.groupBy(DATE_COL).agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"), F.count("*").alias("n"))
            lo, hi, d_lo, d_hi, largest, timeless = by_date.agg(
                F.min("lo"), F.max("hi"), F.min(DATE_COL), F.max(DATE_COL), F.max(F.when(F.col(DATE_COL).isNotNull(), F.col("n"))),
                F.coalesce(F.sum(F.when(F.col(DATE_COL).isNull(), F.col("n"))), F.lit(0))).first()
            if timeless:
                (batch.where(F.col(ts_col).isNull()).write.mode("overwrite")
                 .parquet(f"{quarantine_dir(target_dir)}/batch={batch_id}"))
            if lo is None:
                return
            ensure_folder(spark, target_dir)
            held = (spark.read.schema(b.schema).parquet(target_dir)
                    .where(F.col(DATE_COL).between(d_lo, d_hi) & F.col(ts_col).between(lo, hi))
                    .where(key_ranges(b.where(F.col(ts_col).isNotNull()), [k for k in keys if k != ts_col]))
                    .select(*[F.col(k).alias(f"_held_{k}") for k in keys]))
            same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
            fresh = b.where(F.col(ts_col).isNotNull()).join(held, same, "left_anti")
            # one task per date and share of its keys: a hot date is split by its volume
            shares = -(-largest // rows_per_file)
            fresh = fresh.repartition(DATE_COL, F.pmod(F.xxhash64(*keys), F.lit(shares)))
            fresh.write.mode("append").partitionBy(DATE_COL).parquet(target_dir)
        finally:
            b.unpersist()

    return write


def read_target(spark, target_dir: str) -> DataFrame:
    """The upsert target without its date partition column."""
    return spark.read.parquet(target_dir).drop(DATE_COL)


def run_upsert(stream: DataFrame, target_dir: str, checkpoint_dir: str, keys: Sequence[str], ts_col: str,
               name: str = "upsert") -> None:
    """Drain `stream` once (availableNow) through the insert-when-not-matched sink."""
    q = (stream.writeStream.foreachBatch(insert_new(target_dir, keys, ts_col)).queryName(name)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
