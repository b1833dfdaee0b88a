"""Operator 10, benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of 10 consecutive item words (an item of fewer words is one pattern of
its own length).  The search works on word hashes with blocks of two words (one word for
patterns shorter than two).  For patterns of m words:

* the shift table says for each block hash how far the window may move: m - 1 (nothing can end
  before) for a block that no pattern holds, less for others, 0 for the last block of a pattern;
* positions are probed m - 1 words apart, every window holds exactly one probe, and from a probe
  the search goes on by shifts until it reaches the next probe (all probes of a slice advance
  together, as arrays, and die there);
* where the shift is 0 the hash of the last block selects the patterns (sorted pattern hashes),
  and the words are compared directly.

The benchmark is read in blocks of about 200,000 patterns (a stated query set against all rows),
dealt by a running sum: each block is one broadcast table of bounded size, and a second block is a
second pass.  A document is split over nothing: each row is searched whole in its own task, without
a shuffle; with several blocks the rows are numbered and written first, and their hits are merged
by that number, so no key can be hot.

Defined cases: null text has no words; an item without words has no window; repeated items count
as one item per identifier; null item identifiers are ignored in the list of items; repeated
documents are reported row by row; empty tables give no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text, materialise
from tidepool.session import table_path

WINDOW = 10
PATTERN_BLOCK = 200_000
TABLE_BITS = 20

HITS = "n_words long, hit_words array<int>, items array<string>"


class Patterns:
    """Shift and hash tables of all patterns of one length m."""

    def __init__(self, grams: np.ndarray, items: np.ndarray):
        """grams: (n, m) word hashes of the patterns; items: the item number of each."""
        self.m = m = grams.shape[1]
        self.block = 2 if m >= 2 else 1
        self.reach = m - self.block + 1
        whole = _whole(grams)
        order = np.argsort(whole, kind="stable")
        self.keys, self.grams, self.items = whole[order], grams[order], items[order]
        self.shift = np.full(1 << TABLE_BITS, self.reach, dtype=np.int8 if m < 128 else np.int32)
        for j in range(self.block - 1, m):  # block that ends at word j of a pattern
            np.minimum.at(self.shift, _slot(grams[:, j], grams[:, j - 1] if self.block == 2 else None), m - 1 - j)

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, pattern index) of each occurrence; `first` bounds the rows."""
        m, reach = self.m, self.reach
        n = len(words)
        if n < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(m - 1, n, reach)
        limit = np.minimum(at + reach, n)  # the next probe takes over there
        found = []
        while len(at):
            s = self.shift[_slot(words[at], words[at - 1] if self.block == 2 else None)]
            found.append(at[s == 0])
            at = at + np.maximum(s, 1)
            alive = at < limit
            at, limit = at[alive], limit[alive]
        ends = np.concatenate(found)
        starts = ends - (m - 1)
        row = np.searchsorted(first, starts, side="right") - 1
        starts = starts[first[row + 1] >= starts + m]  # inside one row
        if not len(starts):
            return starts, starts
        seen = words[starts[:, None] + np.arange(m)]
        key = _whole(seen)
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        count = hi - lo
        at = np.repeat(np.arange(len(starts)), count)
        pattern = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        same = (self.grams[pattern] == seen[at]).all(axis=1)
        return starts[at[same]], pattern[same]


def _slot(last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    h = last if before is None else last + before * np.uint64(0x9E3779B97F4A7C15)
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _whole(grams: np.ndarray) -> np.ndarray:
    h = np.zeros(len(grams), dtype=np.uint64)
    for j in range(grams.shape[1]):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + grams[:, j]
    return T.mix(h)


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, word bounds of the rows) for slices of a string column."""
    for a, b, data, off in T.slices(texts):
        starts, ends, first = T.word_spans(data, off, T.ALNUM)
        yield a, b, T.span_hashes(data, starts, ends), first


def compile_patterns(ids: list[str], texts: list[str], window: int) -> list[Patterns]:
    by_length: dict[int, tuple[list, list]] = {}
    for a, b, h, first in word_hashes(pa.array(texts, pa.string())):
        for i in range(b - a):
            w = h[first[i]:first[i + 1]]
            m = min(window, len(w))
            if m:
                grams, items = by_length.setdefault(m, ([], []))
                g = np.lib.stride_tricks.sliding_window_view(w, m)
                grams.append(g)
                items.append(np.full(len(g), a + i))
    return [Patterns(np.concatenate(g), np.concatenate(i)) for _, (g, i) in sorted(by_length.items())]


def search(docs: DataFrame, items: list[tuple[str, str]], window: int = WINDOW) -> DataFrame:
    """The columns of `docs` before its last, the text, with n_words, hit_words (positions) and items
    (identifiers found), for one block of items."""
    others = docs.columns[:-1]
    ids = [i for i, _ in items]
    texts = [t for _, t in items]
    shared = docs.sparkSession.sparkContext.broadcast((ids, texts))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, patterns = shared.value[0], compile_patterns(*shared.value, window)
        for batch in batches:
            texts = batch.column(len(others))
            for a, b, h, first in word_hashes(texts):
                hit = np.zeros(len(h) + 1, dtype=np.int32)
                pairs = []
                for p in patterns:
                    starts, which = p.find(h, first)
                    np.add.at(hit, starts, 1)
                    np.add.at(hit, starts + p.m, -1)
                    pairs.append(np.stack([np.searchsorted(first, starts, side="right") - 1, p.items[which]], axis=1))
                words = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
                bounds = np.searchsorted(words, first)
                where = words - np.repeat(first[:-1], np.diff(bounds))
                found: list[list[str]] = [[] for _ in range(b - a)]
                if pairs:
                    for row, item in np.unique(np.concatenate(pairs), axis=0):
                        if names[item] is not None:
                            found[row].append(names[item])
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(a, b - a) for i in range(len(others))], pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(where.astype(np.int32))),
                    pa.array(found, pa.list_(pa.string()))], [*others, "n_words", "hit_words", "items"])

    return docs.mapInArrow(T.task(scan), StructType([*docs.schema.fields[:-1], *StructType.fromDDL(HITS).fields]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       window: int = WINDOW, pattern_block: int = PATTERN_BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, hit_words, items (sorted identifiers)."""
    docs = id_and_text(docs, id_col, text_col)
    items = materialise(_dealt(benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")),
                               pattern_block), "items")
    blocks = [r.block for r in items.select("block").distinct().orderBy("block").collect()]
    held = lambda block: [(r.item_id, r.text) for r in items.where(F.col("block") == block).collect()]
    if len(blocks) < 2:
        found = search(docs, held(blocks[0]) if blocks else [], window)
    else:
        found = _joined(docs, [lambda block=block: held(block) for block in blocks], window)
    return found.withColumn("items", F.array_sort(F.array_distinct("items")))


def _dealt(items: DataFrame, pattern_block: int) -> DataFrame:
    """item_id, text, block: blocks of about `pattern_block` patterns (an item is at most a pattern for
    each two characters), by a running sum inside each partition on top of the sums before it."""
    items = materialise(items.withColumn("no", F.monotonically_increasing_id()), "items")
    items = items.withColumn("part", F.shiftright("no", 33)).withColumn("size", F.floor(F.length("text") / 2) + 1)
    before = items.groupBy("part").agg(F.sum("size").alias("own"))  # a row per partition
    before = before.select("part", (F.sum("own").over(W.orderBy("part")) - F.col("own")).alias("before"))
    inside = F.sum("size").over(W.partitionBy("part").orderBy("no")) - F.col("size")
    return items.withColumn("inside", inside).join(before, "part").select(
        "item_id", "text", F.floor((F.col("before") + F.col("inside")) / pattern_block).alias("block"))


def _joined(docs: DataFrame, blocks: list, window: int) -> DataFrame:
    """The hits of all blocks (functions that read one), merged by the number of the row."""
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered")
    first, *rest = [search(rows.select("row", *(["doc_id"] if i == 0 else []), "text"), block(), window) for i, block in enumerate(blocks)]
    first = materialise(first, "hits")
    out = first.select("row", "hit_words", "items").where(F.size("hit_words") > 0)
    for one in rest:
        out = out.unionByName(materialise(one.where(F.size("hit_words") > 0).select("row", "hit_words", "items"), "hits"))
    merged = out.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("_words"),
                                    F.flatten(F.collect_list("items")).alias("_items"))
    return first.join(merged, "row", "left").select(
        "doc_id", "n_words", F.coalesce("_words", "hit_words").alias("hit_words"), F.coalesce("_items", "items").alias("items"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(table_path(sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM b),
s AS (SELECT doc_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: {{'i': i, 'g': array_to_string(w[i:i + m - 1], ' ')}})) AS x
      FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m),
h AS (SELECT doc_id, item, x.i AS i, s.m AS m FROM s JOIN p ON s.m = p.m AND x.g = p.g),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
