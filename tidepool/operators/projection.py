"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalar import parse_ts, safe_ratio


def cast_rename(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(source column, Spark type, new name) triples in one projection."""
    return df.select(*[F.col(src).cast(t).alias(dst) for src, t, dst in spec])


def with_ratio(df: DataFrame, name: str, num: str, den: str) -> DataFrame:
    """Computed column; NULL where the denominator is 0."""
    return df.withColumn(name, safe_ratio(num, den))


def in_range(df: DataFrame, col: str, lo: Any, hi: Any) -> DataFrame:
    """Inclusive range filter (pushed to the Parquet scan as two bounds)."""
    return df.filter(F.col(col).between(lo, hi))


def in_set(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    """Membership filter (pushed down as an IN filter)."""
    return df.filter(F.col(col).isin(list(values)))


def split_good_bad(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """Every row lands on exactly one side; a NULL predicate counts as bad."""
    ok = F.coalesce(good, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def parse_failures(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows whose raw value is present but did not parse."""
    return df.agg(F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNull()).alias("parse_failures"))


@dataclass(frozen=True)
class ReaderField:
    """One field of a reader schema (P13): its name, type, older names, default."""

    name: str
    type: str
    aliases: tuple[str, ...] = ()
    default: Any = None
    nullable: bool = True


def conform(df: DataFrame, fields: Sequence[ReaderField]) -> DataFrame:
    """Project rows written with one schema onto a reader schema.

    Per reader field: the first non-NULL of its name and aliases, among the columns the data has,
    cast to its type; a field the data lacks becomes its default.  A required field falls back to
    its default where it is NULL; without a default, a required field that the data lacks is an
    error at once, and a NULL in one an error when the row is read.  Fields the reader does not
    know are dropped.  A single projection -- no codec.
    """
    have = set(df.columns)
    out = []
    for f in fields:
        values = [F.col(c).cast(f.type) for c in (f.name, *f.aliases) if c in have]
        if f.default is not None and (not values or not f.nullable):
            values.append(F.lit(f.default).cast(f.type))
        if not f.nullable and f.default is None:
            if not values:
                raise ValueError(f"required field {f.name!r} is missing from the data and has no default")
            values.append(F.raise_error(F.lit(f"required field {f.name!r} is NULL and has no default")).cast(f.type))
        out.append((F.coalesce(*values) if values else F.lit(None).cast(f.type)).alias(f.name))
    return df.select(*out)
