"""Operator 2, n-gram Jaccard join with signature trees.

A document's set holds its distinct k-word shingles (64-bit hashes).  Documents with equal sets
are one class.  Two classes link when 100 * |x & y| >= percent * |x | y|; the result is the
connected component of every document.  The join is exact:

1. Routing.  Shingles are ordered by (frequent, hash).  With a = ceil(percent |x| / 100), the first
   k common shingles of two sets that link stand among the first |x| - a + k of x, and so for y.
   With k = half the plain prefix, a set stays only if so many of its first shingles (k of the
   smallest partner size) occur in another set at all; this is repeated once on those that stay,
   and leaves little but near copies.  What stays and shares a first shingle with a set of the
   same or a neighbouring size class, directly or over others, forms a block.  The frequent
   shingles (at most 65,536, counted over all documents) come last in the order, so a passage
   that many documents hold rarely matters; the order never changes the result.
2. Trees.  The sets of a block are the leaves of a signature tree, ordered by their smallest
   hashes.  A node holds the OR of its leaves' token bitmaps, their range of sizes and the
   largest number of tokens that share a bit with another.  Two trees (or one with itself) are
   traversed together; a pair of nodes is pruned if its sizes cannot match, if even the largest
   possible overlap is too small, or if all its leaves are connected already.
3. Surviving leaves are compared in full.

A block above 2,000 sets or 2,000,000 shingles is divided by size class (sizes that can link are
in the same or the next class) and hash into parts within these bounds; each pair of parts that
can link is a unit of its own.  So a task holds two bounded parts at a time, whatever the block.
Equal sets are folded map-side, before anything is compared; pairs within a group are never
listed, because connected leaves are skipped.

Sets are numbered, and everything up to the components is keyed by that number: an identifier may
have several texts, so it names no set.  A set's text is fetched from its first row by identifier and
128-bit digest of the text.

Defined cases: null text is the empty text; empty sets link with nothing, and their component is
their own identifier; repeated rows of an identifier each get a row, and if their texts differ
they are linked; rows with a null identifier are documents of their own, and null is smaller than
any other identifier, so a component that holds such a row is null; a very long text is shingled
whole, in slices; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.graph import components
from tidepool.llm.shared import documents, id_and_text, materialise
from tidepool.operators.joins import maybe_broadcast

WORDS, PERCENT = 4, 85
FREQUENT = 65_536
PART_SETS, PART_SHINGLES = 2_000, 2_000_000
FANOUT = 8


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row, with empty arrays for texts without words."""
    for a, b, data, off in T.slices(texts):
        starts, ends, first = T.word_spans(data, off, T.SPACED)
        h = T.span_hashes(data, starts, ends)
        grams = T.gram_hashes(h, k)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= k:
                yield a + i, np.unique(grams[lo:hi - k + 1])
            elif hi > lo:
                yield a + i, T.gram_hashes(h[lo:hi], hi - lo)
            else:
                yield a + i, np.zeros(0, np.uint64)


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """The most frequent shingles, sorted by hash (at most FREQUENT; they only shape the order)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = [s for _, s in shingle_sets(batch.column(0).slice(lo, 2000), k) if len(s)]
                if not part:
                    continue
                s = np.sort(np.concatenate(part))
                edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
                n = np.diff(edge)
                often = n >= 4
                yield pa.RecordBatch.from_arrays([pa.array(s[edge[:-1][often]].view(np.int64)), pa.array(n[often])], ["token", "n"])

    found = docs.select("text").mapInArrow(T.task(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toPandas()["token"].to_numpy(dtype=np.int64)
    return np.sort(top.view(np.uint64))


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, d1, d2 (digest of the text), n (set size), k1, k2 (128-bit key of the set), prefix
    (shingles) of every row.  docs: doc_id, text, d1, d2."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[(frequent & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                n, k1, k2, prefix, size = [], [], [], [], []
                for _, s in shingle_sets(part.column(1), k):
                    n.append(len(s))
                    k1.append(int(np.add.reduce(T.mix(s ^ np.uint64(0x51ED270B7A3F9C15)))))
                    k2.append(int(np.add.reduce(T.mix(s + np.uint64(0x2545F4914F6CDD1D)))))
                    p = len(s) - (percent * len(s) + 99) // 100 + 1 if len(s) else 0
                    p = p - 1 + max(1, p // 2) if p else 0
                    late = maybe[(s & np.uint64(0xFFFFF)).astype(np.int64)]
                    if late.any():
                        at = np.flatnonzero(late)
                        late[at] = frequent[np.minimum(np.searchsorted(frequent, s[at]), len(frequent) - 1)] == s[at]
                        s = np.concatenate([s[~late], s[late]])
                    prefix.append(s[:p])
                    size.append(p)
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                values = np.concatenate(prefix).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), part.column(3), pa.array(n, pa.int64()), pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    ["doc_id", "d1", "d2", "n", "k1", "k2", "prefix"])

    return docs.mapInArrow(T.task(run), "doc_id long, d1 long, d2 long, n long, k1 long, k2 long, prefix array<long>")


class Tree:
    """A signature tree over sets: per level, bottom up, OR bitmaps, size ranges, largest bit excess."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        words = bits // 64
        size = np.array([len(s) for s in sets], dtype=np.int64)
        bitmap = np.zeros((len(sets), words), dtype=np.uint64)
        token = np.concatenate(sets)
        bit = (token % np.uint64(bits)).astype(np.int64)
        np.bitwise_or.at(bitmap.reshape(-1), np.repeat(np.arange(len(sets)) * words, size) + (bit >> 6),
                         np.uint64(1) << (bit & 63).astype(np.uint64))
        excess = size - np.bitwise_count(bitmap).sum(axis=1)
        self.levels = [(bitmap, size, size, excess)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, ex = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at)))


def _possible(x: tuple, p: np.ndarray, y: tuple, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether any leaves below nodes p of level x and q of level y can link."""
    lo = x[1][p] + y[1][q]
    hi = np.minimum(x[2][p], y[2][q])
    ok = hi * 100 >= percent * np.maximum(x[1][p], y[1][q])
    at = np.flatnonzero(ok)
    both = np.bitwise_count(x[0][p[at]] & y[0][q[at]]).sum(axis=1)
    overlap = np.minimum(hi[at], both + np.minimum(x[3][p[at]], y[3][q[at]]))
    ok[at] = (100 + percent) * overlap >= percent * lo[at]
    return ok


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(x) + len(y) - common)


def join_sets(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected, among `left` (right None) or between left and right
    (numbered after left).  Sets are distinct, sorted and not empty."""
    if not left or (right is not None and not right):
        return []
    sets = left + (right or [])
    order_l = _order(left)
    order_r = order_l if right is None else _order(right) + len(left)
    bits = max(256, 1 << int(2 * max(len(s) for s in sets)).bit_length())
    bits = min(bits, 1 << 16)
    tree_l = Tree([sets[i] for i in order_l], bits)
    tree_r = tree_l if right is None else Tree([sets[i] for i in order_r], bits)
    label = np.arange(len(sets))
    links = []

    def compare(i: int, j: int) -> None:
        if label[i] != label[j] and linked(sets[i], sets[j], percent):
            links.append((i, j))
            label[label == max(label[i], label[j])] = min(label[i], label[j])

    merged = order_l if right is None else np.concatenate([order_l, order_r])[np.argsort(
        np.array([sets[i][0] for i in np.concatenate([order_l, order_r])]), kind="stable")]
    for i, j in zip(merged[:-1], merged[1:]):  # neighbours first: most of a group of copies connects here
        if right is None or (i < len(left)) != (j < len(left)):
            compare(i, j)

    top_l, top_r = len(tree_l.levels) - 1, len(tree_r.levels) - 1
    stack = [(top_l, top_r, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        a, b, p, q = stack.pop()
        x, y = tree_l.levels[a], tree_r.levels[b]
        keep = _possible(x, p, y, q, percent) & ~_connected(label, order_l, order_r, a, b, p, q)
        p, q = p[keep], q[keep]
        if not len(p):
            continue
        if a == 0 and b == 0:
            for i, j in zip(order_l[p], order_r[q]):
                compare(int(i), int(j))
            continue
        if a:
            p, q = _children(p, q, len(tree_l.levels[a - 1][0]))
        if b:
            q, p = _children(q, p, len(tree_r.levels[b - 1][0]))
        a, b = max(a - 1, 0), max(b - 1, 0)
        if right is None:  # one tree with itself: each pair once, no leaf with itself
            once = p < q if a == 0 else p <= q
            p, q = p[once], q[once]
        step = max(1, (1 << 22) // (bits // 64 * 8))
        stack += [(a, b, p[i:i + step], q[i:i + step]) for i in range(0, len(p), step)]
    return links


def _order(sets: list[np.ndarray]) -> np.ndarray:
    """Similar sets next to each other: by their smallest hashes, then size."""
    key = np.array([[*(s[:3]), *([np.uint64(2**64 - 1)] * (3 - len(s)))] for s in sets], dtype=np.uint64)
    return np.lexsort((np.array([len(s) for s in sets]), key[:, 2], key[:, 1], key[:, 0]))


def _connected(label, order_l, order_r, a, b, p, q) -> np.ndarray:
    """Whether all leaves below both nodes of a pair are in one component."""
    lo, hi = [], []
    for order, level, node in ((order_l, a, p), (order_r, b, q)):
        at = np.arange(0, len(order), FANOUT ** level)
        mine = label[order]
        lo.append(np.minimum.reduceat(mine, at)[node])
        hi.append(np.maximum.reduceat(mine, at)[node])
    return np.minimum(*lo) == np.maximum(*hi)


def _children(p: np.ndarray, q: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    kids = (p[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
    other = np.repeat(q, FANOUT)
    return kids[kids < size], other[kids < size]


def _needed(n: Column, percent: int) -> Column:
    """First shingles that a set of n must share: half the plain prefix of its smallest partner."""
    least = F.floor((n * percent + 99) / 100)
    return F.greatest(F.lit(1), F.floor((least - F.floor((least * percent + 99) / 100) + 1) / 2))


def _size_class(n: Column, percent: int) -> Column:
    """Sizes that can link differ by one class at most."""
    return F.floor(F.log(n) / -F.log(F.lit((percent - 1) / 100))).cast("int")


def survivors(tokens: DataFrame, percent: int) -> DataFrame:
    """The rows rep, n, token of the sets that share enough first shingles with any others."""
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    hits = tokens.join(shared, "token").groupBy("rep").agg(F.count("*").alias("hits"), F.min("n").alias("n"))
    stay = hits.where(F.col("hits") >= _needed(F.col("n"), percent)).select("rep")
    return tokens.join(stay, "rep", "left_semi")


def blocks(tokens: DataFrame, percent: int) -> DataFrame:
    """rep, block, n: sets connected over shingles shared inside a size class or with the next.  Each
    set hangs on the smallest of its shingle and class, a minimum that is combined map-side."""
    t = tokens.withColumn("c", _size_class(F.col("n"), percent))
    low = materialise(t.groupBy("token", "c").agg(F.min("rep").alias("low"), F.count("*").alias("held")), "lows")
    inside = t.join(low.where("held > 1"), ["token", "c"]).select(F.col("rep").alias("a"), F.col("low").alias("b"))
    upper = low.select("token", (F.col("c") - 1).alias("c"), F.col("low").alias("next"))
    across = low.join(upper, ["token", "c"]).select(F.col("next").alias("a"), F.col("low").alias("b"))
    found = components(inside.unionByName(across)).select(F.col("node").alias("rep"), F.col("component").alias("block"))
    members = found.unionByName(found.select(F.col("block").alias("rep"), "block").distinct())
    return members.join(tokens.groupBy("rep").agg(F.max("n").alias("n")), "rep")


def units(members: DataFrame, percent: int) -> DataFrame:
    """rep, with the unit (block, u, v) and side for every unit it belongs to.  members: rep, block, n."""
    m = members.withColumn("c", _size_class(F.col("n"), percent))
    total = m.groupBy("block").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    small = (F.col("sets") <= PART_SETS) & (F.col("shingles") <= PART_SHINGLES)
    m = m.join(total.select("block", small.alias("small")), "block")
    whole = m.where("small").select("rep", "block", F.lit("").alias("u"), F.lit("").alias("v"), F.lit(0).alias("side"))
    large = m.where("NOT small")
    parts = large.groupBy("block", "c").agg(
        F.greatest(F.ceil(F.count("*") / PART_SETS), F.ceil(F.sum("n") / PART_SHINGLES)).cast("int").alias("parts"))
    own = large.join(parts, ["block", "c"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    name = lambda c, i: F.concat_ws("/", c.cast("string"), i.cast("string"))
    me = name(F.col("c"), F.col("part"))
    same = own.select("rep", "block", "part", me.alias("me"), "c", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    same = same.select("rep", "block", F.when(F.col("part") <= F.col("j"), F.col("me")).otherwise(name(F.col("c"), F.col("j"))).alias("u"),
                       F.when(F.col("part") <= F.col("j"), name(F.col("c"), F.col("j"))).otherwise(F.col("me")).alias("v"),
                       (F.col("part") > F.col("j")).cast("int").alias("side"))
    out = whole.unionByName(same)
    for step in (-1, 1):
        near = parts.select("block", (F.col("c") - step).alias("c"), F.col("parts").alias("theirs"))
        other = own.join(near, ["block", "c"]).select("rep", "block", me.alias("me"), "c", F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)).alias("j"))
        they = name(F.col("c") + step, F.col("j"))
        out = out.unionByName(other.select("rep", "block", (they if step < 0 else F.col("me")).alias("u"), (F.col("me") if step < 0 else they).alias("v"),
                                           F.lit(0 if step > 0 else 1).alias("side")))
    return out


def verify(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Links a, b inside the units.  rows: block, u, v, side, rep, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                key = list(zip(*[batch.column(i).to_pylist() for i in range(5)]))
                for i, s in shingle_sets(batch.column(5), k):
                    yield key[i], s

        for unit, group in groupby(stream(), key=lambda r: r[0][:3]):
            sides: tuple[list, list] = ([], [])
            ids: tuple[list, list] = ([], [])
            for (_, _, _, side, rep), s in group:
                if len(s):
                    sides[side].append(s)
                    ids[side].append(rep)
            found = join_sets(sides[0], sides[1] if unit[1] != unit[2] else None, percent)
            name = ids[0] + ids[1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([name[i] for i, _ in found], pa.int64()), pa.array([name[j] for _, j in found], pa.int64())], ["a", "b"])

    keyed = rows.select("block", "u", "v", "side", "rep", "text").repartition("block", "u", "v").sortWithinPartitions("block", "u", "v")
    return keyed.mapInArrow(T.task(run), "a long, b long")


def texts_of(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """rep, text: one text of each set of `sets` (rep, lead: doc_id, d1, d2 of its first row)."""
    wanted = sets.select("rep", F.col("lead.doc_id").alias("lead_id"), "lead.d1", "lead.d2")
    same = F.col("doc_id").eqNullSafe(F.col("lead_id"))
    found = docs.join(maybe_broadcast(wanted, 1_000_000), ["d1", "d2"]).where(same)
    return found.groupBy("rep").agg(F.any_value("text").alias("text"))  # repeated rows


def same_identifier(held: DataFrame) -> DataFrame:
    """Links a, b between the sets of an identifier that has several.  held: doc_id, rep."""
    several = (held.where("doc_id IS NOT NULL AND rep IS NOT NULL").groupBy("doc_id")
               .agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").select("doc_id", "b"))
    return held.join(several, "doc_id").where("rep > b").select(F.col("rep").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id."""
    docs = id_and_text(docs, id_col, text_col).withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})
    rows = materialise(signatures(docs, words, percent), "signatures")
    key = ["n", "k1", "k2"]
    sets = rows.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "d1", "d2")).alias("lead"), F.any_value("prefix").alias("prefix"))
    sets = materialise(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")
    held = materialise(rows.select("doc_id", *key).join(sets.select(*key, "rep"), key, "left").select("doc_id", "n", "rep"), "held")

    tokens = sets.select("rep", "n", F.explode("prefix").alias("token"))
    tokens = materialise(survivors(tokens, percent), "survivors")
    tokens = materialise(survivors(tokens, percent), "survivors")
    dealt = materialise(units(materialise(blocks(tokens, percent), "members"), percent), "units")
    texts = texts_of(docs, sets.join(dealt.select("rep").distinct(), "rep", "left_semi"))
    links = verify(texts.join(dealt, "rep"), words, percent)
    found = components(links.unionByName(same_identifier(held)))

    grouped = sets.select("rep", "lead.doc_id").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("group", F.coalesce("component", "rep"))
    lowest = grouped.groupBy("group").agg(F.min(F.struct("doc_id")).alias("low"))  # null is the smallest
    of_set = grouped.join(lowest, "group").select("rep", F.col("low.doc_id").alias("component_id"))
    full = held.join(of_set, "rep", "left")
    empty = held.where("n = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    of_id = (full.where("n > 0").join(empty, "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min(F.struct("component_id")).alias("by_id")))  # an empty text beside others of its identifier
    done = full.where("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = full.where("n = 0").select("doc_id", F.col("n").alias("n_shingles")).join(of_id, "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("by_id").isNotNull(), F.col("by_id.component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return done.unionByName(alone)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


# The set of a document, its links by comparing whole sets, and their components by recursion.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS x, b.n AS y, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id
      AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * o >= 85 * (x + y - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, len(s) AS n_shingles, c.component_id FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
