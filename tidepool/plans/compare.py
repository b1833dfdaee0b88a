"""Order-insensitive comparison of a Spark result with rows from another engine.

Used by the tests and `scripts/check_oracle.py`: same column names, same row count, and
the same multiset of rows, floats equal within a relative 1e-9 (two engines sum in
different orders, so the last bits of a double may differ).
"""

from __future__ import annotations

import math


def _sort_key(row):
    out = []
    for x in row:
        if isinstance(x, float):
            x = "nan" if math.isnan(x) else float(f"{x:.4g}")
        out.append((x is None, str(type(x)), x if x is not None else 0))
    return tuple(out)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, (float, int)) or isinstance(b, float) and isinstance(a, (float, int)):
        if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
            return True
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(_same(x, y) for x, y in zip(a, b))
    return a == b


def diff_rows(cols: list[str], rows: list[tuple], other_cols: list[str], other_rows: list[tuple]) -> list[str]:
    """Problems found (empty when the results agree)."""
    if sorted(cols) != sorted(other_cols):
        return [f"columns {cols} vs {other_cols}"]
    order = [other_cols.index(c) for c in cols]
    other_rows = [tuple(r[i] for i in order) for r in other_rows]
    if len(rows) != len(other_rows):
        return [f"rows {len(rows)} vs {len(other_rows)}"]
    a = sorted((tuple(r) for r in rows), key=_sort_key)
    b = sorted((tuple(r) for r in other_rows), key=_sort_key)
    bad = [(x, y) for x, y in zip(a, b) if not _same(x, y)]
    return [f"{len(bad)} rows differ, e.g. {bad[:3]}"] if bad else []
