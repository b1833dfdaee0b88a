"""Operator 13 against direct definitions: the libraries' own encodings, cuts by set intersection, links by loops."""

import base64
import hashlib
import json
from bisect import bisect
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF001
from tidepool.llm import registry
from tidepool.llm import token_align as A

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        a_bytes = {int(i): base64.b64decode(x) for x, i in map(bytes.split, f)}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return a, a_bytes, b, b_bytes


def groups_of(text, tokenizers):
    """[(A ids, B ids)] by the definition: byte offsets where tokens of both end cut them."""
    a, a_bytes, b, b_bytes = tokenizers
    if not text:
        return []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(a_bytes[i] for i in x) != want or b"".join(map(b_bytes, y)) != want:
        return []
    ends = [np.cumsum([len(a_bytes[i]) for i in x]).tolist(), np.cumsum([len(b_bytes(i)) for i in y]).tolist()]
    out = []
    lo = 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        out.append(tuple(ids[bisect(end, lo):bisect(end, cut)] for ids, end in zip((x, y), ends, strict=True)))
        lo = cut
    return out


def brute(rows, tokenizers):
    found = [(i, groups_of(t, tokenizers)) for i, t in rows]
    times = [Counter((a, b) for x, y in g for a in x for b in y) for _, g in found]
    held = Counter(p for c in times for p in c)
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for (i, g), c in zip(found, times, strict=True):
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in c.items()),
                    hashlib.sha256(spelt.encode()).hexdigest() if g else ""))
    return out


EDGES = ["", None, " ", "a", "holds ▁ the mark", "<|endoftext|> and <s> </s> <unk> <0x41>", "\U0001f600 emoji Жизнь 中文", "x" * 3000,
         "tab\tand\r\nlines\n\n  spaces  ", "é́ ﬁ ½", "\x00\x01 controls", "0123456789" * 50, "same words same words same words",
         "a \n b", "in\nner\tspace ok", "can't we'll 12 3", "x\u00a0y \u3000z", "mark in ▁ word▁s", "one  two",
         " ".join(f"word{i} of a long text," for i in range(3000))]


def rows_of(df):
    return Counter(tuple(r[c] for c in COLS) for r in df.collect())


@pytest.mark.parametrize(("block", "large"), [(A.BLOCK_BYTES, A.LARGE), (2000, 1), (2000, 3)])
def test_against_brute_force(make, edge_rows, tokenizers, monkeypatch, block, large):
    monkeypatch.setattr(A, "BLOCK_BYTES", block)
    monkeypatch.setattr(A, "LARGE", large)
    rows = edge_rows + [(500 + i, t) for i, t in enumerate(EDGES)] + [(None, "a"), (500, "the id again")]
    assert rows_of(A.alignment_report(make(rows))) == Counter(brute(rows, tokenizers))


def test_query_on_its_table(spark, tokenizers):
    t = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = registry.queries()["op13_token_align"](spark, SF001)
    assert got.columns == COLS
    assert rows_of(got) == Counter(brute([(r["doc_id"], r["text"]) for r in t], tokenizers))


def test_groups_are_the_operators_output(make, tokenizers):
    rows = [(i, t) for i, t in enumerate(EDGES)]
    for r in A.align(make(rows)).collect():
        a_lo, b_lo = [0, *r.a_cuts], [0, *r.b_cuts]
        got = [(r.a_ids[p:q], r.b_ids[s:t]) for p, q, s, t in zip(a_lo, r.a_cuts, b_lo, r.b_cuts, strict=False)]
        assert got == groups_of(rows[r.doc_id][1], tokenizers)


def test_lanes_and_links_in_parts_change_nothing(monkeypatch, tokenizers):
    pair = A.Pair(*A.default_paths())
    text = [EDGES[-1], "", EDGES[6], EDGES[7], EDGES[-1]]
    whole = A.Block(pair, text)
    linked = {(d, k): n for d, k, n in zip(*whole.linked(), strict=True)}
    monkeypatch.setattr(A, "LANE", 3)
    monkeypatch.setattr(A, "LISTED", 5)
    parts = A.Block(pair, text)
    assert parts.a_hi.tolist() == whole.a_hi.tolist() and parts.b_hi.tolist() == whole.b_hi.tolist()
    assert {(d, k): n for d, k, n in zip(*parts.linked(), strict=True)} == linked


def test_no_cut_inside_a_text():
    """Ends that meet only at the end of a document: one group, however long."""
    a_hi, b_hi = A.lockstep(np.array([*range(2, 2001, 2), 2001]), np.array([*range(1, 2000, 2), 2001]), np.array([1001]))
    assert (a_hi.tolist(), b_hi.tolist()) == ([1001], [1001])


def test_another_file_is_left_to_its_library(tmp_path, tokenizers):
    a_path, _ = A.default_paths()
    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, spec["pre_tokenizer"]]}
    other = tmp_path / "digits.json"
    other.write_text(json.dumps(spec))
    from tokenizers import Tokenizer

    assert A.ByteLevel(str(other)).encode(" in 2024").tolist() == Tokenizer.from_file(str(other)).encode(" in 2024").ids


def test_empty_table(no_docs):
    assert A.alignment_report(no_docs).collect() == []
    assert A.align(no_docs).collect() == []
