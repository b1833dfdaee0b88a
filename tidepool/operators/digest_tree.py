"""What differs between two tables, found from digests before rows are read.

A table is kept in folders by key range (`write_ranges`), with a digest tree beside it: per range the
number of rows and two order-free digests (bitwise xor and sum of 64-bit row hashes, so neither order nor
repeated rows matter to one and hide from both), and per level the same over `FANOUT` nodes below.  Two
trees are compared from the top: only children of nodes that differ are looked at, and only ranges that
differ are read.  It also checks a copy against its original: no node differs, or the ranges to copy again.

The digest of a range is one aggregate, combined map-side; a range's rows never meet.  NULL keys are a
range of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.joins import maybe_broadcast

FANOUT = 16
LEVELS = 4  # above the ranges
PRUNED = 10_000  # as many ranges are named in the read itself
RANGE = "_range"
DIGEST = ("n", "x", "s")
NODE = "level int, node long, n long, x long, s decimal(38,0)"


def range_of(key: Column, width: int) -> Column:
    return F.floor(key / F.lit(width)).cast("long")


def digest_tree(df: DataFrame, key: str, width: int, levels: int = LEVELS) -> DataFrame:
    """level, node, n, x, s: the digests of all ranges (level 0) and of the nodes above them."""
    columns = [F.col(f"`{c}`") for c in sorted(c for c in df.columns if c != RANGE)]
    hashes = df.select(range_of(F.col(f"`{key}`"), width).alias("node"), F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit(1), *columns).alias("g"))
    base = hashes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("g").cast("decimal(38,0)")).alias("s"))
    # each range counts for itself and its node of every level: a few rows a range, not a scan a level
    each = base.select(F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"), "node", *DIGEST)
    up = F.floor(F.col("node") / F.pow(F.lit(float(FANOUT)), F.col("level"))).cast("long").alias("node")
    return each.groupBy("level", up).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").cast("decimal(38,0)").alias("s"))


def write_ranges(df: DataFrame, path: str, key: str, width: int, levels: int = LEVELS) -> None:
    """The table in folders by key range under `path/rows`, its digest tree under `path/tree`, and its
    columns under `path/columns` (an empty table has no folder to read them from).  Rows are dealt by range,
    adaptively: few files a range, and a range with very many rows is split."""
    df.limit(0).write.parquet(f"{path}/columns")
    rows = df.withColumn(RANGE, range_of(F.col(f"`{key}`"), width)).hint("rebalance", F.col(RANGE))
    rows.write.partitionBy(RANGE).parquet(f"{path}/rows")
    digest_tree(read_ranges(df.sparkSession, path).drop(RANGE), key, width, levels).write.parquet(f"{path}/tree")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(T.StructType([*columns.fields, T.StructField(RANGE, T.LongType())])).parquet(f"{path}/rows")


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODE).parquet(f"{path}/tree")


def differing_ranges(a: DataFrame, b: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The ranges (column RANGE) whose digests differ, found from the top of both trees down."""
    parents = None
    for level in range(levels, -1, -1):
        sides = []
        for tree in (a, b):
            nodes = tree.where(F.col("level") == level).select("node", *DIGEST)
            if parents is not None:
                above = F.floor(nodes.node / FANOUT).cast("long")
                nodes = nodes.join(maybe_broadcast(parents, 1_000_000), above.eqNullSafe(F.col("parent")), "left_semi")
            sides.append(nodes)
        x, y = sides[0].alias("x"), sides[1].alias("y")
        same = F.col("x.node").eqNullSafe(F.col("y.node"))
        for c in DIGEST:
            same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
        only = [p.join(q, same, "left_anti").select(F.col(f"{n}.node").alias("parent")) for p, q, n in ((x, y, "x"), (y, x, "y"))]
        parents = only[0].unionByName(only[1]).distinct().checkpoint()  # read by both sides of the next level
    return parents.select(F.col("parent").alias(RANGE))


def rows_in(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """The rows of a table kept by `write_ranges` that lie in `ranges`; other folders are not read."""
    rows = read_ranges(spark, path)
    named = [r[0] for r in ranges.limit(PRUNED + 1).collect()]
    if len(named) > PRUNED:  # too many to name
        return rows.join(ranges.withColumnRenamed(RANGE, "_asked"), F.col(RANGE).eqNullSafe(F.col("_asked")), "left_semi").drop(RANGE)
    asked = F.col(RANGE).isin([n for n in named if n is not None])
    return rows.where(F.coalesce(asked, F.lit(False)) | (F.col(RANGE).isNull() if None in named else F.lit(False))).drop(RANGE)


def table_diff(spark: SparkSession, before: str, after: str, levels: int = LEVELS) -> DataFrame:
    """change (added, removed), the columns, and n: by how many rows the tables at two paths differ."""
    ranges = differing_ranges(read_tree(spark, before), read_tree(spark, after), levels)
    old, new = (rows_in(spark, p, ranges) for p in (before, after))
    columns = [F.col(f"`{c}`") for c in old.columns]
    signed = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    net = signed.groupBy(*columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return net.select(F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"), *columns, F.abs("_net").alias("n"))
