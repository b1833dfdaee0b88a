"""Mergeable sketches kept as tables (A15, M9), and heavy keys found with one.

Quantiles: one KLL sketch per key and hour, written once; any window of hours is answered by merging its
sketches, without the rows.  `sketch_size` gives the parameter that holds a rank error.

Heavy keys: a frequent-items sketch, merged over the tasks, gives a bounded list in which no key above
the share can be missing; the list is counted exactly, so the result has no error either way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the sketches' published error bounds.  KLL: rank error 2.296 / k^0.9021 at 99 %.
# Frequent items: count error 3.5 / size of all rows, always.
KLL_FACTOR, KLL_POWER = 2.296, 0.9021
ITEMS_FACTOR = 3.5
KLL_MIN, KLL_MAX = 8, 65535
ITEMS_MAX = 1_000_000

SAFETY = 3  # the 99 % bound is about 2.6 deviations; thrice that is never passed in practice


def sketch_size(rank_error: float) -> int:
    """KLL parameter k with which the rank error stays below `rank_error` (with SAFETY to spare)."""
    k = math.ceil((KLL_FACTOR * SAFETY / rank_error) ** (1 / KLL_POWER)) if 0 < rank_error < 1 else KLL_MAX + 1
    if k > KLL_MAX:
        raise ValueError(f"a rank error of {rank_error} needs a sketch beyond k = {KLL_MAX}")
    return max(KLL_MIN, k)


def quantile_sketches(df: DataFrame, keys: Sequence[str], at: str, value: str, rank_error: float = 0.01) -> DataFrame:
    """keys, hour, rows, n (values that are not NULL), sketch: what to store.  Partial sketches are merged
    map-side, so a hot key is a sketch a task; memory per key and hour follows k, not the rows."""
    hour = F.date_trunc("hour", at).alias("hour")
    return df.groupBy(*keys, hour).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"),
        F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(sketch_size(rank_error))).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """keys, rows, n and the quantiles of all hours of `sketches` (filter them to a window first); NULL for a
    key without values."""
    merged = sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("_s"))
    picked = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("_s", F.lit(float(p)))).alias(name) for p, name in zip(ps, names, strict=True)]
    return merged.select(*keys, "rows", "n", *picked)


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, quantiles: DataFrame, ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """keys and, per quantile, how far its exact rank among `df` is from p (0 where p lies within the ranks
    of the value's copies): one scan, one row a key on the other side."""
    asked = quantiles.select(*[F.col(k).alias(f"_q_{k}") for k in keys], *[F.col(n).alias(f"_q_{n}") for n in names])
    rows = df.join(asked, [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys])

    def share(held: Column) -> Column:
        return F.try_divide(F.count_if(held), F.count(value))

    errors = [F.greatest(share(F.col(value) < F.col(f"_q_{n}")) - p, p - share(F.col(value) <= F.col(f"_q_{n}")), F.lit(0.0)).alias(n)
              for p, n in zip(ps, names, strict=True)]
    return rows.groupBy(*keys).agg(*errors)


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """key, rows, share of every key that holds at least `share` of all rows (NULL is a key).

    A key with more than 2 * 3.5 / size of the rows is always in the sketch's list.  At most 2 / share keys
    can have an estimate as high as a heavy one, so that many are asked for: the list is bounded, and
    broadcast to count its keys exactly."""
    if not 0 < share <= 1:
        raise ValueError(f"a share is above 0 and at most 1, not {share}")
    asked = math.ceil(2 / share)
    size = 1 << math.ceil(math.log2(max(2 * ITEMS_FACTOR * 2 / share, asked)))
    if size > ITEMS_MAX:
        raise ValueError(f"a share of {share} needs a list beyond {ITEMS_MAX} keys")
    listed = df.selectExpr(f"approx_top_k(`{key}`, {asked}, {size}) AS top").select(F.explode("top").alias("t"))
    listed = F.broadcast(listed.select(F.col("t.item").alias("_listed")))
    counts = (df.select(key).join(listed, F.col(key).eqNullSafe(F.col("_listed")), "left_semi")
              .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    total = df.agg(F.count(F.lit(1))).scalar()  # no column is read: row counts from the file footers
    return counts.where(F.col("rows") >= F.lit(share) * total).select(key, "rows", F.round(F.col("rows") / total, 6).alias("share"))
