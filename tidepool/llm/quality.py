"""Operator 3, quality classifier: a generalised additive model with pairwise interactions.

Each document becomes a short vector of text statistics (`features`, array code over Arrow
batches).  The model is an intercept, one lookup table per feature and one table per chosen pair
of features.  Training boosts the tables in turn, feature after feature, with shallow trees over
the binned feature; the pairs that still explain most of the gradient are then boosted in the
same way.  A score is the logistic function of a sum of table entries, found by array lookups.

Training reads at most `max_train_rows` labelled rows (those with the smallest identifier hash;
the only bound in this operator); scoring reads every row and whole text.  Rows whose
crc32(doc_id as text) mod 4 is 2 are held out.  Labels, lang, source and doc_id never enter a
score.

Defined cases: null text is the empty text, which is scored like any other; a null identifier is
not held out and never joins a label; a label that is null is ignored, repeated labels of a
document are averaged and rounded; without usable labels every score is 0.5; repeated rows are
scored one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text
from tidepool.session import table_path

MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS, N_PAIRS = 120, 60, 6
RATE = 0.15

FEATURES = ["log_words", "log_bytes", "word_length", "upper", "symbol", "period_comma", "bang", "bar", "digit",
            "non_ascii", "newline", "repeat_1", "repeat_2", "repeated_line", "long_word"]

# byte classes: 0 other symbol, 1 lower, 2 upper, 3 digit, 4 non-ASCII, 5 blank, 6 newline, 7 . or ,, 8 !, 9 |
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 4
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], _CLASS[0x0A] = 5, 6
_CLASS[[ord("."), ord(",")]], _CLASS[ord("!")], _CLASS[ord("|")] = 7, 8, 9
_N_CLASS = 10
_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, matrix of FEATURES) for slices of a string column."""
    for a, b, data, off in T.slices(texts):
        rows, size = b - a, np.diff(off)
        key = np.repeat(np.arange(rows) * _N_CLASS, size) + _CLASS[data]
        c = np.bincount(key, minlength=rows * _N_CLASS).reshape(rows, _N_CLASS).astype(float)
        starts, ends, first = T.word_spans(data, off, T.SPACED)
        words = np.diff(first).astype(float)
        h, row, length = T.span_hashes(data, starts, ends), T.spread(first), ends - starts
        chars, letters, n = np.maximum(size, 1), np.maximum(c[:, 1] + c[:, 2], 1), np.maximum(words, 1)

        def again(k: int) -> np.ndarray:
            same = (h[k:] == h[:-k]) & (row[k:] == row[:-k]) if len(h) > k else np.zeros(0, bool)
            return np.bincount(row[k:][same], minlength=rows) / n if len(h) > k else np.zeros(rows)

        ls, le, lf = T.word_spans(data, off, _LINE)
        lrow, lh = T.spread(lf), T.span_hashes(data, ls, le)
        both = lh ^ T.mix(lrow.astype(np.uint64) + np.uint64(1))
        _, seen = np.unique(both, return_index=True)
        extra = np.ones(len(lh), bool)
        extra[seen] = False
        repeated = np.bincount(lrow[extra], weights=(le - ls)[extra], minlength=rows)
        yield a, b, np.stack([
            np.log1p(words), np.log1p(size), np.bincount(row, weights=length, minlength=rows) / n, c[:, 2] / letters, c[:, 0] / chars,
            c[:, 7] / n, c[:, 8] / n, c[:, 9] / n, c[:, 3] / chars, c[:, 4] / chars, c[:, 6] / n, again(1), again(2),
            repeated / chars, np.bincount(row[length > 24], minlength=rows) / n], axis=1)


@dataclass
class Additive:
    """Tables of the model: `edges` and `main` per feature; pairs as (j, k, coarse edges, table)."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    main: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.main)):
            z += table[np.searchsorted(edges, x[:, j], side="right")]
        for j, k, ej, ek, table in self.pairs:
            z += table[np.searchsorted(ej, x[:, j], side="right"), np.searchsorted(ek, x[:, k], side="right")]
        return 1.0 / (1.0 + np.exp(-z))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> int:
    """Best place to split the bins of cumulated gradients (0: none)."""
    if len(g) < 2:
        return 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl)
    best = int(gain.argmax())
    return best + 1 if gain[best] > _gain(g.sum(), h.sum()) + 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two over the bins of one feature, as a value per bin."""
    parts, c = [(0, len(g))], _cut(g, h)
    if c:
        parts = []
        for lo, hi in ((0, c), (c, len(g))):
            d = _cut(g[lo:hi], h[lo:hi])
            parts += [(lo, lo + d), (lo + d, hi)] if d else [(lo, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1.0)
    return out


def _square(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best split of a pair table into four quadrants: values and gain over no split."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    if min(g.shape) < 2:
        return np.zeros_like(g), 0.0
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = tg - a_g - b_g - c_g, th - a_h - b_h - c_h
    gain = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    for rows, cols, q, w in ((slice(0, i + 1), slice(0, j + 1), a_g, a_h), (slice(0, i + 1), slice(j + 1, None), b_g, b_h),
                             (slice(i + 1, None), slice(0, j + 1), c_g, c_h), (slice(i + 1, None), slice(j + 1, None), d_g, d_h)):
        out[rows, cols] = q[i, j] / (w[i, j] + 1.0)
    return out, float(gain[i, j] - _gain(tg, th))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting of the single tables, then of the pairs that gain most."""
    if len(y) == 0:
        return Additive()
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Additive(intercept=float(np.log(rate / (1 - rate))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.main = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    z = np.full(len(y), model.intercept)

    def grad() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, table in zip(binned, model.main):
            g, h = grad()
            step = RATE * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)))
            table += step
            z += step[b]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def grid(v: np.ndarray, j: int, k: int) -> np.ndarray:
        shape = len(coarse[j]) + 1, len(coarse[k]) + 1
        return np.bincount(cells[j] * shape[1] + cells[k], v, shape[0] * shape[1]).reshape(shape)

    g, h = grad()
    gains = sorted(((_square(grid(g, j, k), grid(h, j, k))[1], j, k) for j in range(x.shape[1]) for k in range(j)), reverse=True)
    model.pairs = [(j, k, coarse[j], coarse[k], np.zeros((len(coarse[j]) + 1, len(coarse[k]) + 1))) for gain, j, k in gains[:N_PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for j, k, _, _, table in model.pairs:
            g, h = grad()
            step = RATE * _square(grid(g, j, k), grid(h, j, k))[0]
            table += step
            z += step[cells[j], cells[k]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Additive:
    """Fit on at most `max_train_rows` labelled rows that are not held out.  An identifier may have several
    rows, so the bound is kept once more after the join: the rows with the smallest digests stay."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
            .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.round(F.avg("quality")).alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    # at most max_train_rows narrow rows are broadcast; only their feature vectors reach the driver
    sample = docs.join(F.broadcast(rows), "doc_id").select("quality", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in features(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))], ["quality", "x"])

    found = sample.mapInArrow(T.task(vectors), "quality double, x array<double>")
    found = found.orderBy(F.xxhash64("quality", "x")).limit(max_train_rows).toPandas()
    if found.empty:
        return Additive()
    x, y = np.array(found["x"].tolist()), found["quality"].to_numpy()
    order = np.lexsort((*x.T, y))  # the model does not depend on the order of arrival
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """doc_id, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in features(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return docs.mapInArrow(T.task(apply), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    docs = id_and_text(docs, id_col, text_col)
    scored = score(docs, train(docs, labels, max_train_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(table_path(sf_dir, "labels")))
