"""Sorts, limits and repartitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by(df: DataFrame, *cols: str | Column) -> DataFrame:
    """O1 / O2: total order by several keys (a range-partitioned sort, no single task)."""
    return df.orderBy(*cols)


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """O3: random row order, reproducible through the seed."""
    return df.orderBy(F.rand(seed))


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Top-n by a total order (Spark plans TakeOrderedAndProject: a per-task top-n,
    then a merge of n rows per task -- never a full sort)."""
    return df.orderBy(*order).limit(n)


def newest(df: DataFrame, ts: str, n: int = 20, tie: str | None = None) -> DataFrame:
    """The newest `n` rows by a time column."""
    order = [F.desc(ts)] + ([F.desc(tie)] if tie else [])
    return df.orderBy(*order).limit(n)


def with_partitions(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Hash-repartition to `n` partitions (on keys, if given)."""
    return df.repartition(n, *keys) if keys else df.repartition(n)


def fewer_partitions(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle."""
    return df.coalesce(n)
