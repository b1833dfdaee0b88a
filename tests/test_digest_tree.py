"""The digest tree: same differences as a plain comparison, and only differing ranges read."""

from collections import Counter

import pytest

from tidepool.operators import digest_tree as D
from tidepool.plans.inspect import plan_text

SCHEMA = "k long, v string, `odd name` double"


def rows(n=2000):
    return [(i, f"v{i}", i / 2) for i in range(n)] + [(None, "no key", None), (-5, "below", 1.0), (7, "v7", 3.5), (7, "v7", 3.5)]


def keep(spark, data, path, width=50):
    D.write_ranges(spark.createDataFrame(data, SCHEMA).repartition(3), path, "k", width)


def diff(spark, scratch, before, after):
    keep(spark, before, f"{scratch}/a")
    keep(spark, after, f"{scratch}/b")
    got = Counter()
    for r in D.table_diff(spark, f"{scratch}/a", f"{scratch}/b").collect():
        got[(r.change, r.k, r.v, r["odd name"])] += r.n
    a, b = Counter(before), Counter(after)
    want = Counter({("removed", *x): n for x, n in (a - b).items()}) + Counter({("added", *x): n for x, n in (b - a).items()})
    assert got == want
    return sorted((r[0] is not None, r[0]) for r in D.differing_ranges(D.read_tree(spark, f"{scratch}/a"), D.read_tree(spark, f"{scratch}/b")).collect())


def test_equal_tables_in_any_order(spark, scratch):
    assert diff(spark, scratch, rows(), list(reversed(rows()))) == []


def test_changes_and_the_ranges_they_lie_in(spark, scratch):
    before = rows()
    after = [(k, "new" if k == 120 else v, x) for k, v, x in before if k != 1999 and not (k == 7 and v == "v7" and x == 3.5)]
    after += [(7, "v7", 3.5)] * 2 + [(5000, "added", None), (None, "no key", None)]
    assert diff(spark, scratch, before, after) == [(False, None), (True, 0), (True, 2), (True, 39), (True, 100)]


def test_repeated_rows_do_not_cancel(spark, scratch):
    assert diff(spark, scratch, [(1, "a", 0.5)] * 2 + [(60, "b", None)], [(60, "b", None)]) == [(True, 0)]


def test_swap_between_ranges(spark, scratch):
    assert diff(spark, scratch, [(1, "a", None), (60, "b", None)], [(1, "b", None), (60, "a", None)]) == [(True, 0), (True, 1)]


@pytest.mark.parametrize("empty", [0, 1])
def test_against_an_empty_table(spark, scratch, empty):
    two = [rows(120), []]
    ranges = diff(spark, scratch, two[empty], two[1 - empty])
    assert ranges == [(False, None), (True, -1), (True, 0), (True, 1), (True, 2)]


def test_only_differing_ranges_are_read(spark, scratch):
    before = rows()
    keep(spark, before, f"{scratch}/a")
    keep(spark, [(k, "new" if k == 1010 else v, x) for k, v, x in before], f"{scratch}/b")
    ranges = D.differing_ranges(D.read_tree(spark, f"{scratch}/a"), D.read_tree(spark, f"{scratch}/b"))
    for side in "ab":
        read = D.rows_in(spark, f"{scratch}/{side}", ranges)
        plan = plan_text(read)
        assert "20" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert read.select("k").distinct().count() == 50  # 1000 .. 1049 and nothing else


def test_more_ranges_than_can_be_named(spark, scratch, monkeypatch):
    monkeypatch.setattr(D, "PRUNED", 3)
    assert len(diff(spark, scratch, rows(400), [])) == 10
