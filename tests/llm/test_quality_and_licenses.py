import random
import re

import numpy as np
import pytest

from conftest import SF01
from tidepool.llm import licenses, quality
from tidepool.llm.shared import documents

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    return quality.op3_quality(spark, SF01).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().drop_duplicates("doc_id")
    m = scored.merge(labels, on="doc_id")
    out = m[m.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() > 0.95
    assert (out[out.quality == 1].predicted == 1).mean() > 0.97
    assert scored.score.between(0, 1).all() and len(scored) == 1000


def test_labels_of_held_out_rows_do_not_matter(spark, scored):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    again = quality.classify(documents(spark, SF01), flipped).toPandas()
    assert np.array_equal(again.sort_values("doc_id").score.to_numpy(), scored.sort_values("doc_id").score.to_numpy())


def test_pairs_are_learnt():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    assert ((quality.fit(x, y).score(x) > 0.5) == (y > 0.5)).mean() > 0.95


def test_edge_rows_without_labels_and_empty_tables(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], LABELS)
    rows = quality.classify(edge_docs, none).collect()
    assert len(rows) == len(edge_rows) and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (6, 0, None), (9, None, 1), (None, 1, 1)], LABELS)
    assert len(quality.classify(edge_docs, some).collect()) == len(edge_rows)
    assert quality.classify(no_docs, none).collect() == []


def test_licenses_of_blocks_and_phrases(make):
    rows = [(1, "Released under the MIT License."), (2, "intro\nLicensed, under: the APACHE license Version 2\nmore"), (3, "all rights\nreserved"),
            (4, "cc by nc cc by nc"), (5, None), (6, ""), (7, "This work is licensed under the GNU general license version 3"), (7, "reserved all Rights"), (None, "CC-BY-NC")]
    got = [(r.doc_id, r.n_words, [(p.label, p.start) for p in r.places], sorted({f.label for f in r.found})) for r in licenses.scan_licenses(make(rows)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 5, [("mit", 1)], ["mit"]), (2, 9, [("apache-2", 4)], ["apache-2"]), (3, 3, [], ["all-rights-reserved"]), (4, 6, [("cc-by-nc", 0), ("cc-by-nc", 3)], []),
        (5, 0, [], []), (6, 0, [], []), (7, 11, [], ["gpl-3"]), (7, 3, [], ["all-rights-reserved"]), (None, 3, [("cc-by-nc", 0)], [])], key=str)


@pytest.mark.parametrize(("text", "labels"), [
    ("licensed under CC BY 4.0", ["cc-by"]), ("licensed under CC BY-SA 4.0", ["cc-by-sa"]), ("licensed under CC BY-NC 4.0", ["cc-by-nc"]),
    ("released under the Apache license", []), ("released under the GPL license", []), ("Released under\nthe MIT\nlicense", ["mit"]),
    ("the story was released yesterday under a tree while the driver lost his license", []),
    ("released under a tree of the mit by a man who was asked again and again for the license", []),
    ("* Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:", ["bsd"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy", ["mpl-2"]),
    ("this work is licensed under the gnu lesser general public license version 3", ["lgpl-3"]),
    ("all of our rights and duties are reserved", []), ("all rights x reserved", ["all-rights-reserved"]), ("rights reserved all", ["all-rights-reserved"]),
    ("x " * 3000 + "licensed under the apache\nlicense version 2.0" + " y" * 3000 + " licensed under cc by sa 4.0", ["apache-2", "cc-by-sa"]),
    ("mit license " * 50, []), ("licensed under cc by nc sa 4 0", ["cc-by-nc", "cc-by-sa"])])
def test_templates_are_told_apart(make, text, labels):
    found = licenses.scan_licenses(make([(1, text)], 1)).first().found
    assert sorted({f.label for f in found}) == labels


def plain_matches(text, threshold=licenses.THRESHOLD):
    """(label, start, words, containment) by trying every window of every template."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    out = set()
    for label, told, must in licenses.TEMPLATES:
        t = set(told.split())
        for i in range(len(w)):
            block = w[i:i + licenses._window(len(told.split()))]
            if w[i] in t and len(t & set(block)) >= threshold * len(t) - 1e-9 and set(must.split()) <= set(block):
                out.add((label, i, max(k for k, x in enumerate(block) if x in t) + 1, len(t & set(block)) / len(t), len(t & set(block))))
    return {m[:4] for m in out if not any(n[1] <= m[1] and n[1] + n[2] >= m[1] + m[2] and n[3:] > m[3:] for n in out)}


def test_every_window_is_found(make):
    rng = random.Random(8)
    pool = sorted({x for _, t, _ in licenses.TEMPLATES for x in t.split()}) + ["other", "words", "between"]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(1, 6)):
            part = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(part))
                part = rng.choice([part[:k] + part[k + 1:] or part, part[:k] + [rng.choice(pool)] + part[k:], part[k:] + part[:k]])
            w += part + [rng.choice(pool) for _ in range(rng.randrange(0, 8))]
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w)))
    got = {r.doc_id: {(f.label, f.start, f.words, round(f.containment, 9)) for f in r.found} for r in licenses.scan_licenses(make(rows)).collect()}
    assert got == {i: {(*m[:3], round(m[3], 9)) for m in plain_matches(t)} for i, t in rows}


def test_licenses_edge_rows_and_empty_table(edge_docs, edge_rows, no_docs):
    rows = licenses.scan_licenses(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert licenses.scan_licenses(no_docs).collect() == []


def test_license_scan_has_no_python(edge_docs):
    plan = licenses.scan_licenses(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """One label of an identifier with very many rows: no more than the bound is gathered and fitted."""
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('a text of its own number ', id, ' and some words') AS text")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y: fitted.append(len(x)) or quality.Additive())
    quality.train(docs, labels, max_train_rows=10)
    assert fitted == [10]
