"""Operator 11 against a plain eigendecomposition of the exact covariance."""

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF01
from tidepool.llm import registry
from tidepool.llm import whitening as V

COLS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, wanted=32):
    """(x, sums, deviations, eigenvalues, eigenvectors, trace) with the covariance from exact integers."""
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for _, v in keep]
    n, dim = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    d = np.array([[n * r[j] - sums[j] for j in range(dim)] for r in x], dtype=object)
    cov = (d.T.dot(d) / n ** 3).astype(float)
    e, vec = np.linalg.eigh(cov)
    order = np.argsort(-e)[:wanted]
    return [i for i, _ in keep], d, n, e[order], vec[:, order], np.trace(cov)


def check(df, rows, wanted=32, exact_to=1e-7):
    assert df.columns == COLS
    got = df.collect()
    ids, d, n, e, vec, trace = plain(rows, wanted)
    wanted = min(wanted, len(e))
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i in ids for c in range(1, wanted + 1))
    assert {r.n for r in got} == {n}
    assert Counter((r.vec_id, r.deviation) for r in got) == Counter({k: c * wanted for k, c in Counter((i, sum(int(y) ** 2 for y in x)) for i, x in zip(ids, d, strict=True)).items()})
    for r in got:
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = (d.astype(float) / n) @ vec / np.sqrt(e)
    for c in range(1, wanted + 1):
        mine = defaultdict(list)
        for r in got:
            if r.component == c:
                mine[r.vec_id].append(r.whitened)
        theirs = defaultdict(list)
        for i, w in zip(ids, want[:, c - 1], strict=True):
            theirs[i].append(w)
        a = np.array([y for i in sorted(mine, key=str) for y in sorted(mine[i])])
        b, minus = (np.array([y for i in sorted(theirs, key=str) for y in sorted(s * z for z in theirs[i])]) for s in (1, -1))
        assert min(np.abs(a - b).max(), np.abs(a - minus).max()) < exact_to


def table(spark, rows):
    """Vectors with extra columns of clashing names."""
    return spark.createDataFrame([(i, v, "a", 1.5) for i, v in rows], "vec_id long, embedding array<float>, x string, component double").repartition(3)


def some(n, dim, seed=5):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dim, dim)) * np.linspace(2, 0.2, dim)
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(rng.standard_normal((n, dim)) @ mix)]


def test_query_on_its_table(spark):
    t = pq.read_table(f"{SF01}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    check(registry.queries()["op11_whiten"](spark, SF01), [(r["vec_id"], r["embedding"]) for r in t], exact_to=1e-6)


def test_wide_and_narrow(spark):
    for n, dim in ((300, 7), (90, 40), (60, 1)):
        rows = some(n, dim)
        check(V.whiten(table(spark, rows)), rows)


def test_null_nonfinite_repeated(spark):
    rows = some(50, 5)
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [-float("inf")] * 5)]
    more = [rows[3], rows[3], (rows[4][0], rows[5][1]), (None, rows[6][1]), (None, rows[7][1])]
    check(V.whiten(table(spark, rows + bad + more)), rows + more)


def test_other_lengths_and_huge_entries_are_left_out(spark):
    rows = some(40, 4)
    check(V.whiten(table(spark, rows + [(200, [1.0]), (201, []), (202, [1e30] * 4), (203, [1.0] * 5)])), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 2.0])], [(1, [0.5, 2.0])] * 4])
def test_no_variance_gives_nothing(spark, rows):
    df = V.whiten(table(spark, rows))
    assert df.columns == COLS and df.collect() == []


def test_low_rank_and_equal_variances(spark):
    """A cross of unit vectors has equal variances in 4 of 6 dimensions; the others have none."""
    rows = [(8 * j + k, [float(s * (i == j)) for i in range(4)] + [0.0, 0.0]) for j in range(4) for k, s in enumerate((1, -1) * 4)]
    got = V.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4}
    assert all(r.explained == pytest.approx(0.25, rel=1e-9) for r in got) and got[0].identity_error < 1e-9


def test_missing_copies_of_a_variance_are_found(spark):
    """Few wanted components of a spectrum with copies: steps go on until none can be missing."""
    rows = [(16 * j + k, [float(s * h * (i == j)) for i in range(12)]) for j, h in enumerate([9, 9, 9, 9, 5, 5, 1, 1, 1, 1, 1, 1]) for k, s in enumerate((1, -1) * 8)]
    got = V.whiten(table(spark, rows), components=5).collect()
    share = {r.component: r.explained for r in got}
    whole = 4 * 81 + 2 * 25 + 6
    assert [round(share[c] * whole, 6) for c in range(1, 6)] == [81, 81, 81, 81, 25]


def test_deviation_beyond_long_is_null():
    d = np.array([[1 << 33, 0], [3, 4], [1 << 31, 1 << 31], [3_037_000_499, 0]])
    assert V._squares(d).to_pylist() == [None, 25, None, 3_037_000_499 ** 2]
    assert V._squares(d[1:2]).to_pylist() == [25]
