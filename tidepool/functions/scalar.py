"""Scalar helpers (F1-F15).  Each returns a built-in Column expression, so it stays inside
whole-stage code generation; nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x, digits: int = 6) -> Column:
    """Round a double for comparison with another engine (sums differ in the last bits)."""
    return F.round(_c(x), digits)


def safe_ratio(num, den) -> Column:
    """A ratio that is NULL, not an error, when the denominator is 0 (ANSI mode)."""
    return F.try_divide(_c(num), _c(den))


def parse_ts(x, fmt: str | None = None) -> Column:
    """String to timestamp, NULL on a bad value instead of failing the job."""
    return F.try_to_timestamp(_c(x)) if fmt is None else F.try_to_timestamp(_c(x), F.lit(fmt))


def to_ntz(x) -> Column:
    """A session-zone timestamp back to a zone-less one (what other engines call TIMESTAMP)."""
    return _c(x).cast("timestamp_ntz")


def last_path_segment(x) -> Column:
    """file name from a path."""
    return F.substring_index(_c(x), "/", -1)


def short_file_label(x) -> Column:
    """`part-00000` from `part-00000-<uuid>-c000.snappy.parquet`."""
    return F.substring_index(last_path_segment(x), "-", 2)


def nan_to_null(x) -> Column:
    """NaN becomes NULL (numeric NaN or the string 'NaN')."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def label_or_id(name, ident) -> Column:
    """a name, or `unnamed-<first 8 of id>` when it is missing."""
    return F.coalesce(_c(name), F.concat(F.lit("unnamed-"), F.substring(_c(ident), 1, 8)))


def real_watermark(x) -> Column:
    """parse a watermark string; the epoch placeholder of an idle query becomes NULL."""
    ts = F.try_to_timestamp(_c(x))
    return F.when(ts > F.lit("1971-01-01").cast("timestamp"), ts)


def hot_key(orderkey, hot_share_tenths: int = 9, n_keys: int = 100) -> Column:
    """Deterministic skewed key; key 0 for `hot_share_tenths`/10 of the rows,
    otherwise spread over 1 .. n_keys-1 (integer arithmetic, so SQL can reproduce it)."""
    k = _c(orderkey)
    return F.when(F.pmod(k, F.lit(10)) < hot_share_tenths, F.lit(0).cast("long")) \
        .otherwise(F.pmod(k, F.lit(n_keys - 1)) + 1)

