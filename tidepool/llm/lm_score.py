"""Operator 6, language-model scoring with a weighted backoff automaton.

Tokens are the lower-cased (A-Z) words of a text and one end token.  Training counts every token
of all training documents.  The model:

* unigrams of all words, add-half smoothed: P(w) = (c + 0.5) / (N + 0.5 (V + 1));
* all bigrams and trigrams that occur at least twice (`MIN_NGRAM`), absolutely discounted by 0.5;
* what the discount and the dropped n-grams free goes to the shorter context by a weight that makes
  each distribution sum to one.

Contexts are states, n-grams are arcs, and each state has a failure arc to its longest proper
suffix with its backoff weight.  A text takes at each word the arc of the longest kept n-gram, and
pays the weight of each failure arc before it.

The texts are written once as units of about two million tokens, numbered within the unit.  What
a unit needs of the model are sums over the whole corpus for its own words, bigrams, trigrams and
contexts.  In three rounds every unit sends its distinct keys with its share of the sums, dealt by
key range; the task of a range adds equal keys up and replies to each sender in the order of its
keys:

1. counts of words and bigrams,
2. counts of the trigrams whose bigrams are kept, and sums over the bigrams that follow a word,
3. sums over the trigrams that follow a bigram.

So a key is sent once by each unit that holds it, no matter how frequent it is: a range has at most
one entry of a key for each unit.  A reply also names one sender of each key as its owner, so that
the sums of the next round hold each n-gram once.  Keys and sums travel as packed arrays; all that
a task holds follows the size of a unit or of a range, and the number of ranges grows with the
tokens.  Words and n-grams are compared by 64-bit hash.

Defined cases: null text is the empty text (the end token alone); null and repeated identifiers
are separate documents, row by row (a null one is not held out); without training documents every
probability is 1; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text, materialise

CONTEXT_SHARE = 0.0  # of words in n-grams; 0: all words
NGRAM_SHARE = 0.0  # of kept n-grams; 0: all from MIN_NGRAM occurrences on
LOCAL_SHARE = 2e-6  # not read any more: no value is broadcast
MIN_NGRAM = 2
DISCOUNT = 0.5
UNIT_TOKENS = 1 << 21
RANGE_TOKENS = 1 << 21  # tokens of the corpus for each key range
LEAST_RANGES = 32
PAUSE_S = 0.5  # for the driver to act on a collection
BEGIN, END = np.uint64(0x8C5F1E0B3A7D4296), np.uint64(0x51D7A3C94E80B62F)
WORDS, PAIRS, TRIPLES, AFTER_WORDS, AFTER_PAIRS = range(5)  # what keys are sent
TRAIN, SCORED, NO_ID = 1, 2, 4  # flags of a document

UNIT = "words binary, counts binary, tokens binary, ids binary, flags binary, size long, train_tokens long, train_texts long"
SENT = "unit long, part long, keys binary, values binary"
REPLY = "unit long, part long, sums binary, owned binary, present long"
SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def sequences(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word hashes of all rows of a slice, each row between BEGIN and END."""
    rows = np.arange(len(first) - 1)
    out = np.empty(len(h) + 2 * len(rows), dtype=np.uint64)
    out[first[:-1] + 2 * rows] = BEGIN
    out[first[1:] + 2 * rows + 1] = END
    out[np.arange(len(h)) + 2 * T.spread(first) + 1] = h
    return out


def pair_key(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from those of its first and its last n - 1 words."""
    return T.mix(prefix * np.uint64(0x9E3779B97F4A7C15) + suffix * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))


def pack(a: np.ndarray) -> bytes:
    """An array of integers as compressed planes of bytes, behind its length."""
    planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T)
    return len(a).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, kind: type) -> np.ndarray:
    n, each = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed[8:], decompressed_size=n * each, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(each, n).T).view(kind).reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys ascending, a place of each, and the number of each place's key."""
    order = np.argsort(keys)
    ranked = keys[order]
    head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(keys))))
    return ranked[head], order[head], number


def units(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, text, flags), many to a unit: its words, and the texts as ranks of words by count."""

    def made(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        s, ids, flags = (np.concatenate(x) for x in zip(*parts))
        words, _, number = distinct(s)
        counts = np.bincount(number, minlength=len(words))
        rank = np.empty(len(words), dtype=np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words), dtype=np.uint32)
        train = (flags & TRAIN) > 0
        sizes = np.flatnonzero(s == END) - np.flatnonzero(s == BEGIN)
        row = [pack_sorted(words), pack(counts.astype(np.uint32)), pack(rank[number]), pack(ids), pack(flags), len(s), int(sizes[train].sum()), int(train.sum())]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], [c.split()[0] for c in UNIT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, flags = batch.column(0), batch.column(2).to_numpy().astype(np.uint8) | np.where(batch.column(0).is_null(), NO_ID, 0).astype(np.uint8)
            ids = ids.fill_null(0).to_numpy()
            for a, b, data, off in T.slices(batch.column(1)):
                starts, ends, first = T.word_spans(data, off, T.SPACED)
                parts.append((sequences(T.span_hashes(data, starts, ends), first), ids[a:b], flags[a:b]))
                held += len(parts[-1][0])
                if held >= UNIT_TOKENS:
                    yield made(parts)
                    parts, held = [], 0
        if parts:
            yield made(parts)

    packed = rows.select("doc_id", "text", "flags").mapInArrow(T.task(run), UNIT)
    return materialise(packed.withColumn("unit", F.monotonically_increasing_id()), "units")


class Unit:
    """The texts of a unit one after the other: `word[i]` is the number of the i-th token, and `pair[i]` that of
    the bigram that begins there (-1 at an end)."""

    def __init__(self, row: dict):
        self.number, self.words = row["unit"], unpack_sorted(row["words"])
        order = np.argsort(-unpack(row["counts"], np.uint32).astype(np.int64), kind="stable")
        self.word = order[unpack(row["tokens"], np.uint32)]
        self.ids, self.flags = unpack(row["ids"], np.int64), unpack(row["flags"], np.uint8)
        self.begin, self.end = (int(np.searchsorted(self.words, x)) for x in (BEGIN, END))
        self.doc = np.cumsum(self.word == self.begin) - 1
        self.train = (self.flags[self.doc] & TRAIN) > 0
        s = self.words[self.word]
        inside = self.word[:-1] != self.end
        self.key = pair_key(s[:-1], s[1:])
        self.pairs, at, number = distinct(self.key[inside])
        self.pair = np.full(len(inside), -1, dtype=np.int64)
        self.pair[inside] = number
        self.at = np.flatnonzero(inside)[at]  # a place of each bigram
        self.first, self.last = self.word[self.at], self.word[self.at + 1]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.word[self.train], minlength=len(self.words))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[(self.pair >= 0) & self.train[:-1]], minlength=len(self.pairs))

    def keep_pairs(self, words: np.ndarray, pairs: np.ndarray, often: float, least: float) -> None:
        """With the counts of the corpus: which bigrams are kept, and the trigrams whose bigrams are."""
        allowed = words >= often
        allowed[[self.begin, self.end]] = True
        self.kept = (pairs >= least) & allowed[self.first] & allowed[self.last]
        here = (self.pair >= 0) & self.kept[self.pair]
        self.here = np.flatnonzero(here[:-1] & here[1:])  # where the trigrams begin
        self.triples, at, self.triple = distinct(pair_key(self.key[self.here], self.key[self.here + 1]))
        self.triple_at = self.here[at]

    def triple_counts(self) -> np.ndarray:
        return np.bincount(self.triple[self.train[self.here]], minlength=len(self.triples))

    def contexts(self) -> np.ndarray:
        """The bigrams that a trigram can begin with."""
        return self.kept & (self.last != self.end)


def sums_after(state: np.ndarray, states: int, counts: np.ndarray, alone: np.ndarray) -> list[np.ndarray]:
    """Of the arcs from each state: how many, the sum of their counts, and that of the shorter n-gram's."""
    return [np.bincount(state, w, states).astype(np.int64) for w in (None, counts, alone)]


def sent(unit: int, kind: int, keys: np.ndarray, values: list[np.ndarray], ranges: int) -> list[tuple]:
    """Rows of SENT: sorted keys with their values, one row for each range of keys."""
    edges = np.searchsorted(keys, np.arange(ranges, dtype=np.uint64) << np.uint64(64 - ranges.bit_length() + 1))
    edges = np.append(edges, len(keys))
    return [(unit, kind << 32 | r, pack_sorted(keys[a:b]), pack(np.concatenate([v[a:b] for v in values]).astype(np.int64)))
            for r, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def _added(group: tuple, table: pa.Table) -> pa.Table:
    """Equal keys of all units added up, and the sums told to each sender."""
    rows = table.to_pylist()
    keys = [unpack_sorted(r["keys"]) for r in rows]
    values = [unpack(r["values"], np.int64).reshape(-1, len(k)) for r, k in zip(rows, keys)]
    found, at, number = distinct(np.concatenate(keys))
    sums = np.zeros((len(values[0]), len(found)), dtype=np.int64)
    ends = np.cumsum([len(k) for k in keys])
    for v, e in zip(values, ends):
        sums[:, number[e - v.shape[1]:e]] += v
    owner = np.zeros(len(number), dtype=bool)
    owner[at] = True
    out = []
    for r, k, e in zip(rows, keys, ends):
        part = slice(e - len(k), e)
        mine = sums[:, number[part]]
        out.append((r["unit"], r["part"], pack(mine.reshape(-1)), pack(owner[part].astype(np.uint8)), int((owner[part] & (mine[0] > 0)).sum())))
    T.release()
    return _table(out, REPLY)


def exchange(rows: DataFrame) -> DataFrame:
    """The replies to what the units sent.  Spark deletes the shuffle files of an ended job when the driver
    collects its garbage, which may be rounds later.  It is asked to here: the first collection lets go of the
    job's plan, the second of its shuffles."""
    replies = materialise(rows.groupBy("part").applyInArrow(_added, REPLY), "replies")
    del rows
    for _ in range(2):
        gc.collect()
        replies.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(PAUSE_S)
    return replies


def without_owners(replies: DataFrame) -> DataFrame:
    """The sums alone: who the owner of a key is matters to the next round only."""
    return replies.withColumn("owned", F.lit(None).cast("binary"))


class Replies:
    """What a unit was told, by kind of key."""

    def __init__(self, table: pa.Table):
        self.rows = sorted(table.select(["part", "sums", "owned"]).to_pylist(), key=lambda r: r["part"])

    def of(self, kind: int, size: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(the sums by key, whether the unit is the owner) in the order of the keys that it sent."""
        rows = [r for r in self.rows if r["part"] >> 32 == kind]
        sums = [unpack(r["sums"], np.int64).reshape(size, -1) for r in rows]
        owned = [unpack(r["owned"], np.uint8) for r in rows if r["owned"] is not None]
        return np.concatenate([np.zeros((size, 0), np.int64), *sums], axis=1), np.concatenate([np.zeros(0, np.uint8), *owned]) > 0


def _log_weight(k: np.ndarray, freed: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Failure weight of states: 0 without arcs."""
    return np.log10(np.divide(freed, rest, out=np.ones(len(k)), where=k > 0))


def score_rows(rows: DataFrame) -> DataFrame:
    """SCORES of the rows (doc_id, text, flags) that are to be scored, with a model of those to train on."""
    made = units(rows)
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "train_tokens", "train_texts")]
    size, n, texts = made.agg(*total).first()
    ranges = LEAST_RANGES
    while ranges * RANGE_TOKENS < size:
        ranges *= 2
    least, often = max(MIN_NGRAM, NGRAM_SHARE * n), max(2.0, CONTEXT_SHARE * n)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u = Unit({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                out = sent(u.number, WORDS, u.words, [u.word_counts()], ranges) + sent(u.number, PAIRS, u.pairs, [u.pair_counts()], ranges)
                yield from _table(out, SENT).to_batches()

    def told(left: pa.Table, right: pa.Table) -> tuple[Unit, Replies, np.ndarray, np.ndarray, np.ndarray]:
        """A unit with all that it was told, the counts of its words and bigrams, and the bigrams that it owns."""
        u, replies = Unit(left.to_pylist()[0]), Replies(right)
        (words,), _ = replies.of(WORDS)
        (pairs,), owned = replies.of(PAIRS)
        u.keep_pairs(words, pairs, often, least)
        return u, replies, words, pairs, owned

    def second(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        u, _, words, pairs, owned = told(left, right)
        own = owned & u.kept
        after = sums_after(u.first[own], len(u.words), pairs[own], words[u.last[own]])
        out = sent(u.number, TRIPLES, u.triples, [u.triple_counts()], ranges) + sent(u.number, AFTER_WORDS, u.words, after, ranges)
        T.release()
        return _table(out, SENT)

    def third(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        u, replies, _, pairs, _ = told(left, right)
        (triples,), owned = replies.of(TRIPLES)
        own = owned & (triples >= least)
        at, ask = u.triple_at[own], u.contexts()
        after = sums_after(u.pair[at], len(u.pairs), triples[own], pairs[u.pair[at + 1]])
        out = sent(u.number, AFTER_PAIRS, u.pairs[ask], [x[ask] for x in after], ranges)
        T.release()
        return _table(out, SENT)

    asked = made.groupBy("unit")
    step = lambda f, told, schema: asked.cogroup(told.groupBy("unit")).applyInArrow(f, schema)
    told_1 = exchange(made.mapInArrow(T.task(first), SENT))
    present = told_1.where(F.shiftright("part", 32) == WORDS).agg(F.coalesce(F.sum("present"), F.lit(0))).first()[0]
    told_2 = exchange(step(second, told_1, SENT))
    told_1 = without_owners(told_1)
    told_3 = exchange(step(third, told_1.unionByName(told_2), SENT))
    every = told_1.unionByName(without_owners(told_2)).unionByName(without_owners(told_3))
    z = float(n + 0.5 * (present - (texts > 0) + 1))  # the begin of a text is no token

    def last(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        u, replies, words, pairs, _ = told(left, right)
        (triples,), _ = replies.of(TRIPLES)
        (k, c, alone), _ = replies.of(AFTER_WORDS, 3)
        word_weight = _log_weight(k, 1 - (c - DISCOUNT * k) / np.maximum(words, 1), 1 - (alone + 0.5 * k) / z)
        ask, pair_weight = u.contexts(), np.zeros(len(u.pairs))
        (k, c, alone), _ = replies.of(AFTER_PAIRS, 3)
        pair_weight[ask] = _log_weight(k, 1 - (c - DISCOUNT * k) / np.maximum(pairs[ask], 1), 1 - (alone - DISCOUNT * k) / np.maximum(words[u.last[ask]], 1))

        plain = np.log10((words + 0.5) / z)
        pair_value = word_weight[u.first] + plain[u.last]
        pair_value[u.kept] = np.log10((pairs[u.kept] - DISCOUNT) / words[u.first[u.kept]])
        token = np.flatnonzero(u.pair >= 0)  # the word after each is scored
        value = np.zeros(len(u.word))
        value[token + 1] = pair_value[u.pair[token]]
        context = np.flatnonzero((u.pair[:-1] >= 0) & (u.pair[1:] >= 0))
        value[context + 2] += pair_weight[u.pair[context]]
        there = triples[u.triple] >= least
        at = u.here[there]
        value[at + 2] = np.log10((triples[u.triple[there]] - DISCOUNT) / pairs[u.pair[at]])

        docs, is_token = len(u.ids), u.word != u.begin
        doc, word = u.doc[is_token], u.word[is_token]
        out = pa.table({
            "doc_id": pa.array(u.ids, mask=(u.flags & NO_ID) > 0), "n_tokens": np.bincount(doc, minlength=docs),
            "n_known": np.bincount(doc, words[word] > 0, docs).astype(np.int64), "train_tokens": np.full(docs, n),
            "base_score": np.bincount(doc, plain[word], docs), "score": np.bincount(doc, value[is_token], docs)})
        T.release()
        return out.filter(pa.array((u.flags & SCORED) > 0))

    return step(last, every, SCORES)


def score_texts(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of `docs`
    (doc_id, text), with a model of `train` (text)."""
    rows = docs.select("doc_id", "text", F.lit(SCORED).alias("flags"))
    return score_rows(rows.unionByName(train.select(F.lit(0).cast("long").alias("doc_id"), "text", F.lit(TRAIN).alias("flags"))))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(documents(spark, sf_dir))
    out = held_out(F.col("doc_id"))
    scores = score_rows(docs.select("doc_id", "text", F.when(out, SCORED).otherwise(SCORED | TRAIN).alias("flags")))
    return scores.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
