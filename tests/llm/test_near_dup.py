import random
import re

import numpy as np
import pytest

from tidepool.llm import near_dup as N


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    """Component of each identifier (None counts as the smallest)."""
    ids = [-1 if i is None else i for i, _ in rows]
    sets = [shingles(t, k) for _, t in rows]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                parent[q] = p
    return {i: find(i) for i in ids}, dict(zip(ids, map(len, sets)))


@pytest.mark.parametrize("k,percent,parts", [(4, 85, 2000), (5, 80, 2)])
def test_against_brute_force(edge_docs, edge_rows, monkeypatch, k, percent, parts):
    monkeypatch.setattr(N, "PART_SETS", parts)  # 2: every larger block is divided into parts
    want, size = brute(edge_rows, k, percent)
    got = N.near_duplicates(edge_docs, words=k, percent=percent).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        assert r.n_shingles == size[key]
        assert (-1 if r.component_id is None else r.component_id) == want[key]


def test_trees_lose_no_link():
    rng = random.Random(5)
    for trial in range(20):
        base = [rng.sample(range(10**6), rng.randrange(1, 60)) for _ in range(12)]
        sets = {}
        for _ in range(150):
            s = set(rng.choice(base))
            for _ in range(rng.randrange(0, 8)):
                s.discard(rng.choice(sorted(s))) if rng.random() < 0.5 and len(s) > 1 else s.add(rng.randrange(10**6))
            sets[frozenset(s)] = None
        sets = [np.sort(N.T.mix(np.array(sorted(s), np.uint64))) for s in sets]
        cut = len(sets) // 2
        for left, right in ((sets, None), (sets[:cut], sets[cut:])):
            label = list(range(len(sets)))
            want = list(range(len(sets)))

            def join(lab, i, j):
                p, q = lab[i], lab[j]
                lab[:] = [p if x == q else x for x in lab]

            for i, j in N.join_sets(left, right, 85):
                assert N.linked(sets[i], sets[j], 85)
                join(label, i, j)
            for i in range(len(sets)):
                for j in range(i):
                    if (right is None or (i < cut) != (j < cut)) and N.linked(sets[i], sets[j], 85):
                        join(want, i, j)
            assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_large_group_of_near_copies_is_one_component(make):
    rng = random.Random(2)
    text = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(text)
        w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    assert {r.component_id for r in N.near_duplicates(make(rows)).collect()} == {0}


@pytest.mark.parametrize("parts", [2000, 3])
def test_several_texts_of_an_identifier(make, monkeypatch, parts):
    """Sizes, parts and links go by set: an identifier with a short and a long text loses no link of either."""
    monkeypatch.setattr(N, "PART_SETS", parts)
    short, long = [f"s{i}" for i in range(120)], [f"l{i}" for i in range(1200)]
    rows = [(5, " ".join(short)), (5, " ".join(long)), (7, ""), (7, " ".join(long[:-1])), (6, None)]
    for i in range(10):
        w = list(short)
        w[7 * i] = f"x{i}"
        rows.append((10 + i, " ".join(w)))
    want, _ = brute(rows, 4, 85)
    got = N.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == set(want.items())
    assert {r.component_id for r in got if r.doc_id >= 10 or r.doc_id in (5, 7)} == {5}


@pytest.mark.parametrize("parts", [2000, 3])
def test_rows_without_an_identifier_are_documents_of_their_own(make, monkeypatch, parts):
    monkeypatch.setattr(N, "PART_SETS", parts)
    base = [[f"{f}w{i}" for i in range(60)] for f in "abc"]
    rows = [(None, " ".join(base[0]))] * 4 + [(None, " ".join(base[1]))] + [(None, ""), (None, None)]
    rows += [(i, " ".join([*base[0][:-1], f"x{i}"])) for i in range(5)] + [(20 + i, " ".join([*base[2][:-1], f"y{i}"])) for i in range(5)]
    got = N.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: None for i in range(5)} | {20 + i: 20 for i in range(5)}
    assert sorted(r.n_shingles for r in got if r.doc_id is None) == [0, 0, 57, 57, 57, 57, 57]


def test_empty_table(no_docs):
    assert N.near_duplicates(no_docs).collect() == []


def test_links_around_the_threshold(make):
    rng = random.Random(11)
    rows = []
    for family in range(25):
        base = [f"f{family}w{i}" for i in range(rng.choice([3, 5, 8, 14, 30, 60, 120]))]
        shared = [f"common{i}" for i in range(rng.choice([0, 0, 20]))]
        for _ in range(8):
            w = base + shared
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + ["new"] + w[at:], w[:at] + w[at + 1:], w[:at] + [f"x{rng.randrange(99)}"] + w[at + 1:], w + ["tail"] * rng.randrange(6)])
            rows.append((len(rows), " ".join(w)))
    want, _ = brute(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in N.near_duplicates(make(rows)).collect()} == want
    assert 20 < len(set(want.values())) < len(rows) - 20
