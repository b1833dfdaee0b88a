"""Layout and diagnostics (D1-D4, D11, A9): files, splits and partitions as data.

Every report is a DataFrame computed by Spark from the files themselves: the scan's
hidden `_metadata` column says which file each row came from, `spark_partition_id()`
which task read it, and the `binaryFile` source lists files (without reading their
content unless asked).  Nothing is listed or counted on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.functions.scalar import last_path_segment, short_file_label


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """Files under `path`: plain path, the URI that scans report in `_metadata.file_path` (special
    characters encoded), size and mtime; `content` is never selected, so never read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return listing.load(path).select(F.col("path").alias("file_path"), F.col("_metadata.file_path").alias("file_uri"),
                                     F.col("length").alias("file_bytes"), F.col("modificationTime").alias("mtime"))


def partition_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, partitions, totals) for a Parquet folder read back.

    One grouped scan counts the rows of each (task, file).  `files` starts from the listing, so a
    zero-row file is kept; a scanned file that the listing lacks is an error.  `partitions` starts
    from the tasks themselves, so an idle one is kept.  `files_read` holds full paths.
    """
    rows = spark.read.parquet(path)
    seen = (rows.select(F.spark_partition_id().alias("partition_id"), F.col("_metadata.file_path").alias("file_uri"))
            .groupBy("partition_id", "file_uri").agg(F.count("*").alias("rows")))
    listed = list_files(spark, path)
    by_file = seen.groupBy("file_uri").agg(F.sum("rows").alias("rows"))
    files = listed.join(by_file, "file_uri", "full_outer").select(
        F.coalesce("file_path", F.raise_error(F.concat(F.lit("scanned but not listed: "), F.col("file_uri")))).alias("file_path"),
        short_file_label("file_path").alias("file"), "file_bytes", F.coalesce("rows", F.lit(0)).alias("rows"))
    named = seen.join(listed.select("file_uri", "file_path"), "file_uri")
    by_task = named.groupBy("partition_id").agg(F.sort_array(F.collect_set("file_path")).alias("files_read"))
    parts = _rows_by_task(rows).join(by_task, "partition_id", "left").select("partition_id", "rows", F.coalesce("files_read", F.array().cast("array<string>")).alias("files_read"))
    on_disk = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))
    by_tasks = parts.agg(F.count("*").alias("partitions"), F.count_if(F.col("rows") == 0).alias("empty_partitions"),
                         F.coalesce(F.sum("rows"), F.lit(0)).alias("partition_rows"))
    return files, parts, on_disk.join(by_tasks, F.lit(True))


def _rows_by_task(df: DataFrame) -> DataFrame:
    """partition_id, rows of every scan task, idle ones included (which grouping rows would hide)."""
    tasks = df.sparkSession.range(df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition_id"))
    rows = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))
    return tasks.join(rows, "partition_id", "left").select("partition_id", F.coalesce("rows", F.lit(0)).alias("rows"))


NUMBER = "_number"
BLOCK_ROWS = 1 << 20


def numbered(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The rows of a Parquet scan with `_number`, 0, 1, 2, ... within each group, in the order of the files.
    Rows are numbered within blocks of their file, and a block starts where those before it end: no task
    gets more than a block, and what is summed up has one row per block and group."""
    m, at = F.col("_metadata"), ["_file", "_block"]
    rows = df.select("*", m.file_path.alias("_file"), F.floor(m.row_index / BLOCK_ROWS).alias("_block"), m.row_index.alias("_row"))
    sizes = rows.groupBy(*groups, *at).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in (*groups, *at)], F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*groups, *at)]
    within = F.row_number().over(Window.partitionBy(*groups, *at).orderBy("_row"))
    return rows.withColumn(NUMBER, within - 1).join(starts, same).select(*df.columns, (F.col("_start") + F.col(NUMBER)).alias(NUMBER))


SPLIT = ("file_uri", "block_start", "block_length", "file_bytes")


def split_audit(df: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """One row for each split of a file scan that rows came from: its file, byte range and the
    file's size, and the rows and the key range read from it."""
    m = F.col("_metadata")
    names = (m.file_path, m.file_block_start, m.file_block_length, m.file_size)
    return (df.groupBy(*groups, *[c.alias(n) for c, n in zip(names, SPLIT, strict=True)])
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")))


def split_coverage(splits: DataFrame, groups: Sequence[str] = (), slack: int = 0) -> DataFrame:
    """Per file, its splits and rows, and the bytes that no split covers or several do: each split
    is compared with the furthest end of those before it, and the last end with the file's size.  A split
    without rows is not seen, so a gap of at most `slack` bytes is none: a split that holds but the end
    of a line, or the footer of a Parquet file."""
    before = Window.partitionBy("file_uri").orderBy("block_start", "block_length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("block_start") + F.col("block_length")
    placed = splits.withColumn("_seen", F.coalesce(F.max(end).over(before), F.lit(0)))
    beyond = lambda c: F.when(c > slack, c).otherwise(0)
    gap, overlap = F.col("block_start") - F.col("_seen"), F.least("_seen", end) - F.col("block_start")
    per = placed.groupBy(*groups, "file_uri").agg(
        F.count(F.lit(1)).alias("splits"), F.sum("rows").alias("rows"), F.sum(beyond(gap)).alias("_inner"),
        F.sum(F.greatest(overlap, F.lit(0))).alias("overlap_bytes"), F.max("file_bytes").alias("file_bytes"), F.max(end).alias("_end"))
    return per.select(*groups, "file_uri", "splits", "rows", (F.col("_inner") + beyond(F.col("file_bytes") - F.col("_end"))).alias("gap_bytes"), "overlap_bytes")


def file_stats(df: DataFrame, key: str) -> DataFrame:
    """D3: rows, min and max of `key` per file (the statistics file skipping relies on)."""
    return (df.groupBy(last_path_segment(F.col("_metadata.file_path")).alias("file_name"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")))


def bytes_per_directory(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Parquet bytes and file count per directory under `root`."""
    files = list_files(spark, root, glob=glob)
    return (files.groupBy(F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1).alias("directory"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("bytes")))


# Fixed values of Hadoop's checksum sidecar format (".<name>.crc" next to each file on a
# local checksummed file system): 4 magic bytes "crc\0", a 4-byte big-endian chunk size,
# then one 4-byte big-endian CRC-32 per chunk.
CRC_MAGIC = b"crc\x00"
CRC_HEADER_BYTES = 8
CRC_BYTES = 4

INTEGRITY_SCHEMA = "file_name string, length long, chunk_bytes int, chunks int, bad_chunks int, has_sidecar boolean"


def _check_files(batches):
    """mapInPandas body: for each listed file, stream it and its sidecar in chunks."""
    import os
    import struct
    import zlib

    import pandas as pd

    for pdf in batches:
        out = []
        for path, length in zip(pdf["file_path"], pdf["file_bytes"]):
            local = path[len("file:"):] if path.startswith("file:") else path
            while local.startswith("//"):
                local = local[1:]
            head, name = os.path.split(local)
            side = os.path.join(head, f".{name}.crc")
            if not os.path.exists(side):
                out.append((name, int(length), None, None, None, False))
                continue
            with open(side, "rb") as sf, open(local, "rb") as df:
                magic = sf.read(4)
                chunk = struct.unpack(">i", sf.read(4))[0] if magic == CRC_MAGIC else 512
                n = bad = 0
                while True:
                    block = df.read(chunk)
                    if not block:
                        break
                    stored = sf.read(CRC_BYTES)
                    n += 1
                    if len(stored) < CRC_BYTES or struct.unpack(">I", stored)[0] != zlib.crc32(block):
                        bad += 1
            out.append((name, int(length), chunk, n, bad, True))
        yield pd.DataFrame(out, columns=["file_name", "length", "chunk_bytes", "chunks", "bad_chunks",
                                         "has_sidecar"])


def file_integrity(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Per data file, CRC-32 of each 512-byte chunk against its checksum sidecar.

    The listing is Spark's (`binaryFile`, content not read); each task then streams its own
    files chunk by chunk, so no file passes through the driver and memory per task is one
    chunk.  Sidecars exist only on a local checksummed file system (distributed stores
    checksum blocks themselves), so this is a local-disk diagnostic.
    """
    return list_files(spark, path, glob=glob, recursive=False).mapInPandas(_check_files, INTEGRITY_SCHEMA)
