import random
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import suffix_dedup as S


def brute(rows, length=50):
    low = {}
    key = lambda i: float("inf") if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            low[s] = min(key(i), low.get(s, float("inf")))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if low[b[p:p + length]] < key(i):
                gone[p:p + length] = b"\1" * length
        spans, a = [], None
        for p, g in enumerate([*gone, 0]):
            if g and a is None:
                a = p
            elif not g and a is not None:
                spans.append((a, p))
                a = None
        out.append((i, len(b), tuple(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return Counter(out)


def run(docs, **kw):
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in S.remove_repeats(docs, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 8000, "bucket_bytes": 30000}, {"block_bytes": 8000, "hot_runs": 1}])
def test_against_brute_force(edge_docs, edge_rows, kw):
    assert run(edge_docs, **kw) == brute(edge_rows)


def test_long_documents_are_cut_into_overlapping_segments(make, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 300)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdé ") for _ in range(700))
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randrange(2000))) + passage[rng.randrange(300):] + "x" * i) for i in range(12)]
    table = make(rows, 1).select("doc_id", "text")
    runs = S.Runs(table.toArrow())
    spans = {(int(d), p) for d, a, b in zip(runs.doc, runs.first, runs.last) for p in range(a, b + 1)}
    assert spans == {(d, p) for d, (_, t) in enumerate(sorted(rows)) for p in range(len(t.encode()) - 49)}
    assert run(make(rows)) == brute(rows)


def test_difference_cover_finds_the_smallest_identifier():
    rng = np.random.default_rng(7)
    for alphabet in (1, 2, 5):
        text = rng.integers(97, 97 + alphabet, 1500).astype(np.uint8)
        text[700:900] = text[100:300]
        at = np.sort(rng.choice(1450, 900, replace=False))
        ids = rng.permutation(900)
        low = {}
        for p, i in zip(at, ids):
            s = text[p:p + 50].tobytes()
            low[s] = min(low.get(s, 10**9), i)
        assert S.lowest_by_string(text, at, ids).tolist() == [low[text[p:p + 50].tobytes()] for p in at]


def test_empty_table(no_docs):
    assert run(no_docs) == Counter()
