import re
from collections import Counter

import pytest

from tidepool.llm import pii as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if (k == 1 and max(map(int, m.group().split("."))) > 255) or (k == 2 and not (14 <= len(d) <= 19 and luhn(d))) or (k == 3 and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "", "a@b.c", "a@b", "@b.c x@@y.z", "a@b.c@d.e", "é.a@b-c.de. f@g.h.i@j.k", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.256 0001.2.3.255", "1..2.3.4.5",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111 4111111111111111", "+1 (368) 555-0098", "+1 2", "+12345678901234567", "+1+1234567890", "++44 20 7946 0958-",
    "5 4111111111111111", "x" * 5000 + "1" * 5000 + ".@a.b"])
def test_base_spans(text):
    assert P.base_spans(text) == brute(text)


def test_contexts_discover_unseen_identifiers(make):
    rows = [(i, f"please call desk{i % 3} phone: +1 (368) 555-{1000 + i} today") for i in range(40)]
    rows += [(100, "please call desk1 phone: 555-0199 today"), (101, "we sold 555-0199 units"), (102, "version 4.0 of 2024-01 and 77 others")]
    rows += [(200 + i, f"some words {i}{i}{i}{i}{i} are numbers") for i in range(30)] + [(300, None), (301, "")]
    got = {r.doc_id: r for r in P.find_personal_data(make(rows)).collect()}
    assert all(len(got[i].spans) == 1 and got[i].spans[0].kind == "phone" for i in range(40))
    text = dict(rows)
    assert [text[100][s.start:s.end] for s in got[100].more] == ["555-0199"] and got[100].more[0].kind == "phone"
    assert [text[101][s.start:s.end] for s in got[101].more] == ["555-0199"]  # the value is known now
    assert all(not got[i].more for i in got if i not in (100, 101))


def test_edge_rows_and_empty_table(edge_docs, edge_rows, no_docs):
    got = P.find_personal_data(edge_docs).collect()
    want = Counter((i, tuple((P.KINDS[k], a, b) for a, k, b in brute(t or ""))) for i, t in edge_rows)
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got) == want
    assert P.find_personal_data(no_docs).collect() == []
