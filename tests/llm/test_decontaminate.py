import random
import re
from collections import Counter

import pytest

from tidepool.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(rows, items, window=10):
    patterns = set()
    for item, t in items:
        w = words(t)
        m = min(window, len(w))
        patterns |= {(str(item), tuple(w[i:i + m])) for i in range(len(w) - m + 1) if m}
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, p in patterns:
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a:a + len(p)]) == p:
                    hit.update(range(a, a + len(p)))
                    found.add(item)
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return Counter(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "é", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for k in range(12)] + [(3, text(30)), (99, None), (100, "-- !!")]
    rows = [(i, text(rng.randrange(0, 120))) for i in range(40)]
    rows += [(50, "pre " + items[12][1] + ", post"), (51, None), (52, ""), (50, "pre " + items[12][1]), (None, items[0][1]), (53, "word " * 3000 + (items[-3][1] or ""))]
    return rows, [(k, t) for k, t in items if len(words(t)) != 1 or k % 2]


def run(docs, bench, **kw):
    return Counter((r.doc_id, r.n_words, tuple(r.hit_words), tuple(r["items"])) for r in D.find_contamination(docs, bench, **kw).collect())


@pytest.mark.parametrize("window", [10, 2, 1])
def test_against_brute_force(spark, make, case, window):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'z' AS items", "0 AS n_words")
    assert run(make(rows), bench, window=window) == brute(rows, items, window)


def test_blocks_of_items_give_the_same(spark, make, case):
    rows, items = case
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert run(make(rows), bench, pattern_block=60) == brute(rows, items)


def test_blocks_keep_rows_with_repeated_and_null_identifiers(spark, make, case):
    rows, items = case
    rows = rows + [(None, "alpha Beta " * 40), (None, None), (None, "nothing to find"), (50, "nothing to find"), rows[0]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert run(make(rows), bench, pattern_block=60) == brute(rows, items)


def test_empty_tables(spark, make, no_docs, case):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert run(make([(1, "a b")]), bench) == Counter({(1, 2, (), ()): 1})
    assert run(no_docs, bench) == Counter()
