"""Aggregations.

All of these are declarative group-bys, so Catalyst plans them as partial aggregate ->
shuffle on the grouping key -> final aggregate.  A hot key therefore never travels as raw
rows: every map task folds its share of the key into one partial row before the exchange.
For "the newest row per key" we use `max(struct(...))`, an ordinary
mergeable aggregate, instead of a window with row_number (which would sort a hot key's
rows inside one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalar import rounded


def minmax(df: DataFrame, col: str) -> DataFrame:
    """A1: global min and max of one column."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def summary_stats(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """A2, typed: count, mean, sample stddev, min, max per column, one row per column.

    One scan computes all columns' statistics; the long form is produced by `stack` on the
    single aggregated row, so nothing but that row is reshaped.
    """
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}__n"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).cast("double").alias(f"{c}__min"),
            F.max(c).cast("double").alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__n`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, n, mean, stddev, min_value, max_value)")
    return long.select(
        "column_name", "n",
        rounded("mean", digits).alias("mean"), rounded("stddev", digits).alias("stddev"),
        "min_value", "max_value")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2 as Spark prints it: summary rows with string values."""
    return df.describe(*cols)


def count_by(df: DataFrame, keys: Sequence[str], value_col: str | None = None, name: str = "n",
             descending: bool = True) -> DataFrame:
    """A3 / A4 + O1: rows (or non-NULL values of `value_col`) per key, biggest first.

    The keys themselves break ties so the order is total.
    """
    agg = F.count(F.lit(1)) if value_col is None else F.count(value_col)
    out = df.groupBy(*keys).agg(agg.alias(name))
    first = F.desc(name) if descending else F.asc(name)
    return out.orderBy(first, *[F.asc(k) for k in keys])


def avg_by(df: DataFrame, keys: Sequence[str], col: str, name: str, digits: int = 6) -> DataFrame:
    """Average per key (Spark builds the (sum, count) partials itself)."""
    return df.groupBy(*keys).agg(rounded(F.avg(col), digits).alias(name))


def sum_or_zero(df: DataFrame, col: str, name: str) -> DataFrame:
    """Sum that is 0 rather than NULL on an empty input."""
    return df.agg(F.coalesce(F.sum(col), F.lit(0)).alias(name))


def rows_per_partition(df: DataFrame, col: str) -> DataFrame:
    """Rows, min and max of `col` for each input partition."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("min_value"), F.max(col).alias("max_value")))


def count_by_flag(df: DataFrame, flag: Column, name: str) -> DataFrame:
    """A10: group by a boolean expression."""
    return df.groupBy(flag.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   payload: Sequence[str] = ()) -> DataFrame:
    """A13 with a defined survivor: per key, the row with the greatest `order_cols`.

    `max(struct(order..., payload...))` compares field by field, so it is "newest by
    order_cols, ties broken by the payload" -- and it is a partial aggregate, so a key
    holding a third of the table is folded map-side before the shuffle.
    """
    fields = list(order_cols) + [c for c in payload if c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in fields])


def time_buckets(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (),
                 value: str | None = None) -> DataFrame:
    """Tumbling time buckets (`window`), rows and optional sum / max per bucket."""
    names = ["n"] + ([f"sum_{value}", f"max_{value}"] if value is not None else [])
    aggs = [F.count(F.lit(1)).alias("n")]
    if value is not None:
        aggs += [F.sum(value).alias(names[1]), F.max(value).alias(names[2])]
    return (df.groupBy(F.window(ts, width).alias("w"), *keys).agg(*aggs)
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *names))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float],
                      names: Sequence[str], digits: int = 6) -> DataFrame:
    """Exact, linearly interpolated percentiles per key.

    Spark's `percentile` aggregate keeps a value -> count map per group and merges the maps
    across the partial/final stages, so its memory is bounded by the *distinct* values of a
    group, not its row count; callers bucket continuous values (for example lags to whole
    seconds or milliseconds) to keep that domain bounded.
    """
    aggs = [rounded(F.percentile(value, p), digits).alias(n) for p, n in zip(ps, names)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)


def approx_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float],
                       names: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """A15, fixed memory per group (a mergeable quantile sketch)."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, p, accuracy).alias(n) for p, n in zip(ps, names)])


def balance(counts: DataFrame, count_col: str) -> DataFrame:
    """Min, median, max and max/median of a per-partition or per-key count."""
    return counts.agg(
        F.min(count_col).alias("min_rows"),
        F.median(count_col).alias("median_rows"),
        F.max(count_col).alias("max_rows"),
        F.try_divide(F.max(count_col), F.median(count_col)).alias("max_over_median"),
    )


def rank_values(df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """Distinct (keys, value) pairs as `_v` with their row count `_c` (map-side combined, so a hot
    value is one row), range-partitioned by (keys, value): `_pid` is the range, so a group with
    very many values is spread over several.  Rows without a value keep one pair with NULL."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return counts.repartitionByRange(n, *keys, "_v").withColumn("_pid", F.spark_partition_id())


def ranked_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float],
                       names: Sequence[str], digits: int = 6, partitions: int | None = None) -> DataFrame:
    """A15, exact and safe for hot groups and hot values: linearly interpolated percentiles per key
    (the definition of `percentile` / `quantile_cont`) from cumulative value counts.

    `n` counts all rows of the group; percentiles are over its non-NULL values and NULL if it has
    none.  The distinct values with their counts are written (a small table next to the input);
    the sums of each range give the ranges' rank offsets, running sums inside a range the ranks
    of each value, and one aggregate picks the values around (n - 1) * p.
    """
    from pyspark.sql import Window

    keys = list(keys)
    if not keys:  # one group of all rows
        return ranked_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value, ps, names, digits, partitions).drop("_all")
    ranked = _materialise(rank_values(df, keys, value, partitions))
    same = [f"_b_{k}" for k in keys]
    has = F.col("_v").isNotNull()
    ranges = ranked.groupBy("_pid", *keys).agg(F.sum(F.when(has, F.col("_c")).otherwise(0)).alias("_range"), F.sum("_c").alias("_rows"))
    group = Window.partitionBy(*keys)  # at most one row per range
    ranges = (ranges.withColumn("_before", F.sum("_range").over(group.orderBy("_pid")) - F.col("_range"))
              .withColumn("_n", F.sum("_range").over(group)).withColumn("n", F.sum("_rows").over(group))
              .select(F.col("_pid").alias("_b_pid"), *[F.col(k).alias(b) for k, b in zip(keys, same)], "_before", "_n", "n"))
    placed = ranked.join(ranges, [F.col("_pid") == F.col("_b_pid"), *[F.col(k).eqNullSafe(F.col(b)) for k, b in zip(keys, same)]])
    inside = Window.partitionBy("_pid", *keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    count = F.when(has, F.col("_c")).otherwise(0)
    placed = placed.withColumn("_end", F.col("_before") + F.sum(count).over(inside)).withColumn("_start", F.col("_end") - count)
    aggs = []
    for i, p in enumerate(ps):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when(has & (F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v"))).alias(f"_{side}{i}"))
    out = placed.groupBy(*keys).agg(F.max("n").alias("n"), F.max("_n").alias("_n"), *aggs)
    picked = []
    for i, (p, name) in enumerate(zip(ps, names)):
        h = (F.col("_n") - 1) * F.lit(float(p))
        picked.append(rounded(F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")), digits).alias(name))
    return out.select(*keys, "n", *picked)


def _materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back (cuts the lineage; survives
    the loss of an executor)."""
    from tidepool.session import work_dir

    path = f"{work_dir(df.sparkSession, 'result')}/part"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
