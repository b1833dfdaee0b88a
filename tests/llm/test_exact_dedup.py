import hashlib
import re
from collections import Counter

import pytest

from tidepool.llm import exact_dedup as X


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("hot", [256, 1])
def test_against_brute_force(edge_docs, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(X, "HOT_ROWS", hot)  # 1: every group of two is split over salts
    got = X.exact_dedup(edge_docs).collect()
    size = Counter(norm(t) for _, t in edge_rows)
    low = {}
    for i, t in edge_rows:
        if i is not None:
            low[norm(t)] = min(i, low.get(norm(t), i))
    want = Counter((i, low.get(norm(t)), size[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in edge_rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(size)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_hot_group_is_split_and_counted_whole(make, monkeypatch):
    monkeypatch.setattr(X, "HOT_ROWS", 10)
    rows = [(i, "the same   text") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(30)]
    got = X.exact_dedup(make(rows)).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id < 300} == {(0, 300)}
    assert [r.doc_id for r in got if r.kept and r.doc_id < 300] == [0]


def test_empty_table(no_docs):
    assert X.exact_dedup(no_docs).collect() == []


def test_plan_has_no_python(edge_docs):
    plan = X.exact_dedup(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
