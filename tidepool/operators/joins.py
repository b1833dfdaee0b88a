"""Joins (J1-J8) and the skew tools around them.

Strategy, in order of preference:

1. A side whose size is *proven* small is broadcast.  "Proven" means either bounded by
   construction (a lookup built from `range(n)`) or checked: `take(bound + 1)` of a
   one-literal projection scans partitions incrementally and stops as soon as it has
   `bound + 1` rows, so the check is bounded in both work and driver memory.  A side that
   fails the check is joined by shuffle instead -- never broadcast on hope.
2. Otherwise a shuffle (sort-merge) join on the key, with AQE's skew-join splitting on.
3. When one key holds a large share of the big side and the other side cannot be
   broadcast, the hot keys are salted: the big side's hot rows are spread over `k`
   sub-keys by a deterministic hash (so a retried task puts every row in the same
   sub-key again), and the other side's hot rows are replicated `k` times.  Only the hot
   keys are salted; the hot-key table is bounded by construction (at most `max_hot_keys`
   rows, because a hot key must hold at least total / max_hot_keys rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.sketches import heavy_keys

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Bounded size check: True when `df` has at most `max_rows` rows and about `max_bytes` bytes.

    The rows are counted first, which reads no column (a Parquet side: its footers), and only a side
    that passes is measured (the text form of its values).  Two numbers come back, never a row.
    """
    if max_rows > MAX_BROADCAST_ROWS:
        raise ValueError(f"a broadcast bound above {MAX_BROADCAST_ROWS} rows is not a small table")
    if df.count() > max_rows:
        return False
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))).first()[0] or 0) <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the choice to Spark."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def join_shuffle(big: DataFrame, small: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Force a sort-merge (shuffle) join whatever the sizes."""
    return big.join(small.hint("merge"), on=keys, how=how)


def join_broadcast(big: DataFrame, small: DataFrame, keys: str | Sequence[str], max_rows: int = 100_000,
                   how: str = "inner") -> DataFrame:
    """Broadcast `small` if it passes the bounded size check, else a shuffle join."""
    return big.join(maybe_broadcast(small, max_rows), on=keys, how=how)


def hot_keys(df: DataFrame, key: str, max_hot_keys: int = 1000, rows_per_salt: int = 1_000_000) -> DataFrame:
    """Keys holding at least 1/max_hot_keys of the rows, each with its number of salts: one per
    `rows_per_salt` rows, without a ceiling.

    They are found by a mergeable frequent-items sketch over all rows and counted exactly
    (`heavy_keys`), so none is missed and none too many is salted.  At most `max_hot_keys` keys can
    hold that share, so the table is bounded by construction.  A NULL key joins nothing and is left out.
    """
    salts = F.greatest(F.lit(2), F.ceil(F.col("rows") / rows_per_salt).cast("int"))
    return heavy_keys(df, key, 1 / max_hot_keys).where(F.col(key).isNotNull()).select(key, salts.alias("_salts"))


def salted_sides(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | None = None,
                 salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a salted join, each with a `_salt` column to join on with `key`.

    Big side: hot keys get `_salt` = position of the row in its task modulo the key's salts, so equal
    rows are spread as well; every other key 0.  Any salt of a row is right, because the small
    side's rows of a hot key are repeated once per salt value.  `hot` is hinted for broadcast only
    if it passes the size check (a caller may bring any table).
    """
    at = F.monotonically_increasing_id()
    if hot is not None:
        hot = maybe_broadcast(hot, 100_000)
        b = big.withColumn("_at", at).join(hot, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
        s = small.join(hot, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    else:
        b = big.withColumn("_at", at).withColumn("_salts", F.lit(salts))
        s = small.withColumn("_salts", F.lit(salts))
    b = b.withColumn("_salt", F.pmod(F.col("_at"), F.col("_salts")).cast("int"))
    s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts").cast("int") - 1)))
    return b.drop("_salts", "_at"), s.drop("_salts")


def join_salted(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | None = None,
                salts: int | None = None, max_hot_keys: int = 1000, rows_per_salt: int = 1_000_000,
                strategy: str | None = "merge") -> DataFrame:
    """Inner equi-join on one key with the hot keys salted.

    `hot` is a (key, _salts) table (see `hot_keys`); with `salts` given instead, every key
    is salted `salts` ways (the textbook form).  The result equals `big.join(small, key)`.
    `strategy` is the join hint for the final (key, salt) join: salting is for the case
    where the other side is too big to broadcast, so a shuffle join by default.
    """
    if hot is None and salts is None:
        hot = hot_keys(big, key, max_hot_keys=max_hot_keys, rows_per_salt=rows_per_salt)
    b, s = salted_sides(big, small, key, hot, salts)
    if strategy:
        s = s.hint(strategy)
    return b.join(s, [key, "_salt"]).drop("_salt")


def skew_join_settings(spark: SparkSession, enabled: bool = True, factor: float = 5.0,
                       threshold: str = "64MB") -> None:
    """AQE skew-join splitting (on by default in sessions built here)."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", str(enabled).lower())
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", str(factor))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", threshold)


def key_lookup(spark: SparkSession, n_keys: int = 100, key: str = "join_key", prefix: str = "key_") -> DataFrame:
    """The 100-row lookup of the skew lab: `join_key`, `label` = prefix + key."""
    return (spark.range(0, n_keys).withColumnRenamed("id", key)
            .withColumn("label", F.concat(F.lit(prefix), F.col(key).cast("string"))))


def skew_report(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Rows per key, hottest first, with the key's share of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1))).scalar()  # part of the same query; no column is read
    out = (counts.withColumn("share", F.round(F.try_divide(F.col("rows"), total), 6))
           .orderBy(F.desc("rows"), F.asc(key)))
    return out.limit(top) if top else out
