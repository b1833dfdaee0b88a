import random

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Columns that clash with names the operators use themselves.
EXTRA = ["row", "digest", "block", "n", "gram", "token", "kept", "spans", "rep", "seq", "held_out", "label"]


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}x" for _ in range(n)]


def corpus(seed=1, n=60):
    """Texts with exact copies, near copies, shared passages, short, empty, null and long ones."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 40, 10_000))
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            out.append(rng.choice(out))
        elif kind == 2 and out and out[-1]:
            w = rng.choice([t for t in out if t]).split(" ")
            w[rng.randrange(len(w))] = f"changed{i}"
            out.append(" ".join(w))
        elif kind == 3:
            out.append(" ".join(words(rng, rng.randrange(5, 80), 5000)) + "\n" + passage + " " + " ".join(words(rng, 20, 5000)))
        else:
            out.append(" ".join(words(rng, rng.randrange(30, 200), 5000)))
    return out + [None, "", " \t\n", "one", "Two words", "ÉTÉ déjà vu — naïve", " ".join(words(rng, 6000, 5000)), "a" * 3000, "ab " * 500]


@pytest.fixture(scope="session")
def edge_rows():
    rows = [(i * 3 % 101, t) for i, t in enumerate(corpus())]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "a text without an identifier, long enough to hold a window of fifty bytes"))
    return rows


@pytest.fixture(scope="session")
def make(spark):
    """(doc_id, text) rows as a table with clashing extra columns."""
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)

    def build(rows, parts=3):
        return spark.createDataFrame([(i, t, *[None if k % 2 else "x" for k in range(len(EXTRA))]) for i, t in rows], schema).repartition(parts)

    return build


@pytest.fixture(scope="session")
def edge_docs(make, edge_rows):
    return make(edge_rows).persist()


@pytest.fixture(scope="session")
def no_docs(make):
    return make([], 1)
