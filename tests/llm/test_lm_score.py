import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import lm_score as L
from tidepool.llm.shared import id_and_text, recorded


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


class Plain:
    """The model as a recursive definition over token strings."""

    def __init__(self, texts, context_share, ngram_share):
        seqs = [["<s>", *tokens(t), "</s>"] for t in texts]
        self.c = Counter(w for s in seqs for w in s[1:])
        self.n = sum(self.c.values())
        self.z = self.n + 0.5 * (len(self.c) + 1)
        often = {w for w, c in self.c.items() if w != "</s>" and c >= max(2.0, context_share * self.n)}
        ok = often | {"<s>", "</s>"}
        grams = Counter(tuple(s[i:i + k]) for s in seqs for k in (2, 3) for i in range(len(s) - k + 1) if ok.issuperset(s[i:i + k]))
        self.kept = {g: c for g, c in grams.items() if c >= max(2, ngram_share * self.n)}
        self.total = {(w,): self.c[w] for w in often} | {("<s>",): len(seqs)} | {g: c for g, c in self.kept.items() if len(g) == 2}
        self.after = defaultdict(dict)
        for g, c in self.kept.items():
            self.after[g[:-1]][g[-1]] = (c - 0.5) / self.total[g[:-1]]

    def p(self, h, w):
        if not h:
            return (self.c[w] + 0.5) / self.z
        own = self.after.get(h)
        if not own:
            return self.p(h[1:], w)
        if w in own:
            return own[w]
        return (1 - sum(own.values())) / (1 - sum(self.p(h[1:], x) for x in own)) * self.p(h[1:], w)

    def score(self, t):
        s = ["<s>", *tokens(t), "</s>"]
        return sum(math.log10(self.p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s)))


TEXTS = ["the cat sat on the mat", "the cat sat on a mat", "THE dog sat on the cat", "a dog and a cat", "the cat sat", "zebra", "", None, "the the the the the the",
         "the cat sat on the mat"] * 3 + [f"word{i} the cat number{i}" for i in range(20)]


@pytest.mark.parametrize("local,context,ngram", [(0.0, 0.0, 0.0), (0.02, 0.05, 0.01), (1.0, 1.0, 1.0)])
def test_scores_against_the_definition(make, monkeypatch, local, context, ngram):
    for name, v in (("LOCAL_SHARE", local), ("CONTEXT_SHARE", context), ("NGRAM_SHARE", ngram)):
        monkeypatch.setattr(L, name, v)
    docs = id_and_text(make(list(enumerate(TEXTS))))
    train = docs.where("doc_id % 4 <> 1")
    model = Plain([t for i, t in enumerate(TEXTS) if i % 4 != 1], context, ngram)
    for r in L.score_texts(docs, train).collect():
        w = [*tokens(TEXTS[r.doc_id]), "</s>"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(model.c[x] > 0 for x in w), model.n)
        assert r.base_score == pytest.approx(sum(math.log10((model.c[x] + 0.5) / model.z) for x in w), abs=1e-6)
        assert r.score == pytest.approx(model.score(TEXTS[r.doc_id]), abs=1e-6)


def test_distributions_sum_to_one():
    model = Plain([t for t in TEXTS], 0.0, 0.0)
    words = [*model.c, "never seen"]
    for h in [(), ("<s>",), ("the",), ("the", "cat"), ("<s>", "the"), ("zebra", "cat")]:
        assert sum(model.p(h, w) for w in words) == pytest.approx(1)


def test_without_training_texts(make, no_docs):
    docs = id_and_text(make([(1, "a b"), (2, None)]))
    rows = {r.doc_id: r for r in L.score_texts(docs, docs.where(F.lit(False))).collect()}
    assert rows[1].score == rows[1].base_score == 0 and rows[1].n_tokens == 3 and rows[2].n_known == 0
    assert L.score_texts(id_and_text(no_docs), id_and_text(no_docs)).collect() == []


def test_edge_rows(edge_docs, edge_rows):
    docs = id_and_text(edge_docs)
    rows = L.score_texts(docs, docs).collect()
    assert len(rows) == len(edge_rows) and all(np.isfinite(r.score) and r.n_known == r.n_tokens for r in rows)


def test_all_repeated_ngrams_count_whatever_the_corpus(make):
    # with its default constants: "rare left pair" and its bigrams occur twice in 60,000 tokens
    texts = [f"filler{i} " * 2000 for i in range(30)] + ["rare left pair"] * 2
    docs = id_and_text(make(list(enumerate(texts))))
    model = Plain(texts, 0.0, 0.0)
    got = {r.doc_id: r for r in L.score_texts(docs, docs).collect()}
    assert ("rare", "left", "pair") in model.kept
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(model.score(t), abs=1e-6)


def test_many_units_share_one_model(make):
    docs = id_and_text(make(list(enumerate(TEXTS)))).repartition(7)
    model = Plain([t for i, t in enumerate(TEXTS) if i % 3], 0.0, 0.0)
    with recorded() as made:
        got = {r.doc_id: r for r in L.score_texts(docs, docs.where("doc_id % 3 <> 0")).collect()}
    assert docs.sparkSession.read.parquet(made[0]).count() > 7
    for i, t in enumerate(TEXTS):
        assert got[i].score == pytest.approx(model.score(t), abs=1e-9) and got[i].train_tokens == model.n


def test_null_identifiers_and_flags(make):
    docs = id_and_text(make([(None, "a b a b"), (7, "a b"), (7, "c")]))
    got = sorted((r.doc_id is None, r.n_tokens, r.n_known) for r in L.score_texts(docs, docs.where("text <> 'c'")).collect())
    assert got == [(False, 2, 1), (False, 3, 3), (True, 5, 5)]


def test_no_table_of_ngrams_is_written(make):
    # every table of words or n-grams, one row each, took several times the disk of the texts
    rng = np.random.default_rng(1)
    texts = [" ".join(f"word{w}" for w in rng.zipf(1.3, 2000) % 5000) for _ in range(300)]
    docs = id_and_text(make(list(enumerate(texts))))
    with recorded() as made:
        assert len(L.score_texts(docs, docs).collect()) == 300
    spark = docs.sparkSession
    assert sum(spark.read.parquet(p).count() for p in made) < 5000
    folders = [p.removeprefix("file://").removeprefix("file:") for p in made]
    assert sum(os.path.getsize(f"{d}/{f}") for top in folders for d, _, fs in os.walk(top) for f in fs) < sum(map(len, texts))
