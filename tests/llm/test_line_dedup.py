import hashlib
import random
import re
from collections import Counter

import pytest

from tidepool.llm import line_dedup as L


def key_of(line):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs=5, min_chars=40):
    """Each row a document; all rows with the largest identifier (null below all) keep a repeated line."""
    low = float("-inf")
    held, last = Counter(), {}
    for i, t in rows:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k] += 1
                last[k] = max(last.get(k, low), low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [p for p, x in enumerate(lines) if held[key_of(x)] >= min_docs and last[key_of(x)] != (low if i is None else i)]
        kept = "\n".join(x for p, x in enumerate(lines) if p not in set(gone))
        out.append((i, len(lines), tuple(gone), kept))
    return out


def rows_of(df):
    return Counter((r.doc_id, r.n_lines, tuple(r.dropped), r.text) for r in df.collect())


LONG = "A line of forty code points and a few MORE"
CASES = ([(i, f"head {i}\n  {LONG}\t\n{LONG.upper()}\n\ntail") for i in range(6)]
         + [(10 + i, f"{LONG[:39]}\nÉÀ öffnet große Türen für alle Menschen im Land\r\n{i}") for i in range(7)]
         + [(20 + i, "Ab" * 20 + "\n" + "x" * 40) for i in range(4)]  # held by four documents: kept
         + [(30, "\n".join(["one document repeats this line, which counts only once"] * 9))]
         + [(None, LONG), (None, LONG), (5, LONG), (5, f"head 5\n  {LONG}\t\n{LONG.upper()}\n\ntail")]  # repeated ids, null ids, a repeated row
         + [(40 + i, "\n\n") for i in range(6)] + [(50, None), (51, ""), (52, LONG + "\x0b"), (53, "\x85" + LONG)])


def test_against_brute_force(make, edge_rows):
    rows = edge_rows + [(None if i is None else i + 1000, t) for i, t in CASES]
    assert rows_of(L.drop_repeated_lines(make(rows))) == Counter(brute(rows))


@pytest.mark.parametrize(("min_docs", "min_chars"), [(2, 1), (3, 0), (1, 10)])
def test_thresholds(make, min_docs, min_chars):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["", " ", "a", "A ", "common line", "another one", f"own {i}"]) for _ in range(rng.randrange(12)))) for i in range(40)]
    assert rows_of(L.drop_repeated_lines(make(rows), min_docs=min_docs, min_chars=min_chars)) == Counter(brute(rows, min_docs, min_chars))


def test_only_null_identifiers_hold_a_line(make):
    rows = [(None, LONG + f"\n{i}") for i in range(6)]
    assert rows_of(L.drop_repeated_lines(make(rows))) == Counter(brute(rows))


def test_very_long_text_and_hot_line(make):
    """A text of 30,000 lines whose lines are dropped, and a line that every document holds."""
    many = [f"line number {i} of a text that all of the copies hold in full" for i in range(30_000)]
    rows = [(i, "\n".join(many)) for i in range(5)] + [(100 + i, f"{LONG}\nown {i}") for i in range(400)]
    got = {r.doc_id: (len(r.dropped), hashlib.sha256(r.text.encode()).hexdigest()) for r in L.drop_repeated_lines(make(rows)).collect()}
    whole = hashlib.sha256("\n".join(many).encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert [got[i] for i in range(5)] == [(30_000, empty)] * 4 + [(0, whole)]
    assert sum(n for i, (n, _) in got.items() if i >= 100) == 399 and got[499][0] == 0


def test_empty_table_and_plan(no_docs, edge_docs):
    assert L.drop_repeated_lines(no_docs).collect() == []
    plan = L.drop_repeated_lines(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
