"""Operator 8, suffix deduplication with a difference cover.

Every byte that lies in a string of `length` (50) bytes which also starts in a document with a
smaller identifier is removed; strings are judged on the input.  All strings of all documents
would be sorted by a suffix array; at scale that is done in three distributed steps:

1. Anchors.  The anchor of a 50-byte string is its 20-byte gram of smallest hash (leftmost), so
   equal strings have equal anchors at equal places.  Successive strings with one anchor form a
   run (about 65 bytes for 16 strings).  Only runs whose gram occurs in two documents can hold
   equal strings; the others are left out.  Four bytes per gram are shuffled for this.
2. Equal runs.  Of runs equal byte for byte (digest) the smallest identifier counts; all other
   documents lose these strings, and no more is needed for them.
3. Difference cover.  Of the remaining first runs those matter whose gram has another first run
   (two digests per gram and block tell).  They are dealt by gram, so all equal strings meet in
   one bucket.  There the suffixes at two of three positions are sorted by their triples of bytes
   and named; the names are sorted by triples again, until a name stands for 48 bytes (3, 9, 27,
   48).  Any two strings have a common offset 0, 1 or 2 at which both are sampled, so the rest is
   merged by (leading bytes, name, trailing bytes), and neighbours with equal keys are equal
   strings: the smallest identifier among them decides.

The documents are written once, in blocks of about 2 MB bucketed by block, so no later step moves
text again but for the first runs of step 3.  What goes back to a block is one bit per gram or
run, and the spans found.

Hot texts: a gram or run counts once per block in every shuffle.  A gram with more than
`hot_runs` first runs (the edge of a passage in very many documents) is not gathered: its runs
are cut into single strings, which are grouped by their bytes with a map-side minimum and joined
back.

Defined cases: null text is the empty text; a null identifier counts as larger than all others;
rows that repeat an identifier do not remove each other's strings; texts below 50 bytes lose
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text, materialise
from tidepool.session import work_dir

LENGTH, GRAM = 50, 20
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20  # of input per bucket: about a million grams
SEGMENT = 1 << 20
RUN_BYTES = 2 << 20  # of first runs per bucket of the last step
HOT_RUNS = 20_000
NO_ID = np.iinfo(np.int64).max  # stands for a null identifier

FLAGS = "block long, kind int, bucket int, flags binary"


class Runs:
    """Runs of one block: arrays of doc (row in the block), first, last (strings), gram, digest, lead."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending")])
        self.ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        self.ids_or_null = table.column("doc_id")
        texts = table.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        parts = [p for a, _, data, off in T.slices(texts, SEGMENT) for p in _runs(data, off, a)]
        self.texts = texts
        cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
                for i, t in enumerate((np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))]
        self.doc, self.first, self.last, self.gram, self.digest, self.lead = cols
        self.grams, self.gram_of = np.unique(self.gram, return_inverse=True)

    def repeated(self, flags: dict[int, list]) -> np.ndarray:
        """Runs whose gram occurs in two documents: in two of this block, or by the flags of other blocks."""
        elsewhere = _unpack(flags.get(0), len(self.grams))
        lo = np.full(len(self.grams), NO_ID)
        hi = np.full(len(self.grams), -1)
        np.minimum.at(lo, self.gram_of, self.doc)
        np.maximum.at(hi, self.gram_of, self.doc)
        return (elsewhere | (lo < hi))[self.gram_of]

    def equal(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, smallest identifier of each, key number of each repeated run)."""
        keys, of = np.unique(T.mix(self.gram[repeated] * np.uint64(0x9E3779B97F4A7C15) + self.digest[repeated]), return_inverse=True)
        lowest = np.full(len(keys), NO_ID)
        np.minimum.at(lowest, of, self.ids[self.doc[repeated]])
        return keys, lowest, of

    def divide(self, flags: dict[int, list]) -> tuple[np.ndarray, np.ndarray]:
        """The repeated runs that an equal run of a smaller identifier covers, and the others: first runs."""
        repeated = self.repeated(flags)
        keys, lowest, of = self.equal(repeated)
        covered = _unpack(flags.get(1), len(keys))[of] | (self.ids[self.doc[repeated]] > lowest[of])
        at = np.flatnonzero(repeated)
        return at[covered], at[~covered]


def _runs(data: np.ndarray, off: np.ndarray, row: int) -> Iterator[tuple]:
    """Runs of the rows of one slice; a longer row is cut into overlapping segments."""
    if len(data) > 2 * SEGMENT:
        for s in range(0, len(data) - LENGTH + 1, SEGMENT):
            part = data[s:s + SEGMENT + LENGTH - 1]
            for doc, first, last, gram, digest, lead in _runs(part, np.array([0, len(part)]), row):
                yield doc, first + s, last + s, gram, digest, lead
        return
    n = len(data)
    if n < LENGTH:
        return
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(T._BYTE[data] * T._power(T._R, n), out=total[1:])
    inverse = T._power(T._R_INV, n + 1)
    gram = T.mix((total[GRAM:] - total[:-GRAM]) * inverse[:n - GRAM + 1])
    low = np.uint64((1 << 22) - 1)  # positions below 2 * SEGMENT + 50 fit
    key = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    span, wide = 1, LENGTH - GRAM + 1
    best = key
    while 2 * span <= wide:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < wide:
        best = np.minimum(best[:len(best) - (wide - span)], best[wide - span:])
    anchor = (best & low).astype(np.int64)  # of the string at each position
    inside = np.zeros(len(anchor) + 1, dtype=np.int8)
    size = np.diff(off)
    rows = np.flatnonzero(size >= LENGTH)
    inside[off[rows]] += 1
    np.add.at(inside, np.minimum(off[rows + 1] - LENGTH + 1, len(anchor)), -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(at):
        return
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    first, last = at[head], at[np.append(head[1:], len(at)) - 1]
    doc = np.searchsorted(off, first, side="right") - 1
    spot = anchor[first]
    digest = T.mix((total[last + LENGTH] - total[first]) * inverse[first] + (spot - first).astype(np.uint64) + ((last - first) << 8).astype(np.uint64))
    yield doc + row, first - off[doc], last - off[doc], gram[spot], digest, spot - first


def _unpack(rows: list | None, n: int) -> np.ndarray:
    if not rows:
        return np.zeros(n, dtype=bool)
    out = np.concatenate([np.unpackbits(np.frombuffer(f[8:], np.uint8), count=int.from_bytes(f[:8], "little")) for _, f in sorted(rows)])
    return out.astype(bool)


def _pack(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def _flags(table: pa.Table) -> dict[int, list]:
    out: dict[int, list] = {}
    for kind, bucket, flags in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "flags"))):
        out.setdefault(kind, []).append((bucket, flags))
    return out


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Places in sorted 64-bit keys where the buckets (equal ranges of keys) begin and end."""
    edges = [(i << 64) // buckets for i in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]]).astype(np.int64)


def _segments(values: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Binary cells as one array, and the number of items of each cell."""
    cells = [np.frombuffer(v, dtype) for v in values.to_pylist()]
    return np.concatenate(cells), np.array([len(c) for c in cells])


def repeated_grams(blocks: DataFrame, buckets: int) -> DataFrame:
    """Flags (kind 0) for the grams of each block that another block holds too."""

    def emit(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        grams = Runs(table).grams
        cut = _bounds(grams, buckets)
        used = np.flatnonzero(np.diff(cut))
        low = grams.astype(np.uint32)
        return pa.table({"block": pa.array([block] * len(used), pa.int64()), "bucket": pa.array(used.astype(np.int32)),
                         "keys": pa.array([low[cut[i]:cut[i + 1]].tobytes() for i in used], pa.binary())})

    def resolve(table: pa.Table) -> pa.Table:
        keys, size = _segments(table.column("keys"), "<u4")
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        flag = np.empty(len(keys), dtype=bool)
        flag[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        return _returned(table, 0, flag, size)

    return blocks.groupBy("block").applyInArrow(emit, "block long, bucket int, keys binary").groupBy("bucket").applyInArrow(resolve, FLAGS)


def _returned(table: pa.Table, kind: int, flag: np.ndarray, size: np.ndarray) -> pa.Table:
    ends = np.cumsum(size)
    return pa.table({"block": table.column("block"), "kind": pa.array(np.full(len(size), kind, np.int32)), "bucket": table.column("bucket"),
                     "flags": pa.array([_pack(flag[e - k:e]) for e, k in zip(ends, size)], pa.binary())})


def covered_runs(blocks: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """Flags (kind 1) for the equal runs of each block that a smaller identifier of another block holds."""

    def emit(table: pa.Table, other: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()), "keys": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
        block = table.column("block")[0].as_py()
        runs = Runs(table)
        keys, lowest, _ = runs.equal(runs.repeated(_flags(other)))
        cut = _bounds(keys, buckets)
        used = np.flatnonzero(np.diff(cut))
        return pa.table({"block": pa.array([block] * len(used), pa.int64()), "bucket": pa.array(used.astype(np.int32)),
                         "keys": pa.array([keys[cut[i]:cut[i + 1]].tobytes() for i in used], pa.binary()),
                         "ids": pa.array([lowest[cut[i]:cut[i + 1]].tobytes() for i in used], pa.binary())})

    def resolve(table: pa.Table) -> pa.Table:
        keys, size = _segments(table.column("keys"), "<u8")
        ids, _ = _segments(table.column("ids"), "<i8")
        distinct, of = np.unique(keys, return_inverse=True)
        lowest = np.full(len(distinct), NO_ID)
        np.minimum.at(lowest, of, ids)
        return _returned(table, 1, ids > lowest[of], size)

    sent = blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(emit, "block long, bucket int, keys binary, ids binary")
    return sent.groupBy("bucket").applyInArrow(resolve, FLAGS)


def contested_grams(blocks: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """Flags (kind 2) for the grams of the first runs of each block that have different first runs."""

    def emit(table: pa.Table, other: pa.Table) -> pa.Table:
        out: dict[str, list] = {"bucket": [], "keys": [], "low": [], "high": []}
        if table.num_rows:
            runs = Runs(table)
            first = runs.divide(_flags(other))[1]
            grams, of = np.unique(runs.gram[first], return_inverse=True)
            low, high = np.full(len(grams), np.iinfo(np.uint64).max), np.zeros(len(grams), np.uint64)
            np.minimum.at(low, of, runs.digest[first])
            np.maximum.at(high, of, runs.digest[first])
            cut = _bounds(grams, buckets)
            for i in np.flatnonzero(np.diff(cut)):
                for c, v in (("keys", grams.astype(np.uint32)), ("low", low), ("high", high)):
                    out[c].append(v[cut[i]:cut[i + 1]].tobytes())
                out["bucket"].append(int(i))
        block = [table.column("block")[0].as_py()] * len(out["bucket"]) if table.num_rows else []
        return pa.table({"block": pa.array(block, pa.int64()), "bucket": pa.array(out["bucket"], pa.int32()),
                         **{c: pa.array(out[c], pa.binary()) for c in ("keys", "low", "high")}})

    def resolve(table: pa.Table) -> pa.Table:
        keys, size = _segments(table.column("keys"), "<u4")
        distinct, of = np.unique(keys, return_inverse=True)
        low, high = np.full(len(distinct), np.iinfo(np.uint64).max), np.zeros(len(distinct), np.uint64)
        np.minimum.at(low, of, _segments(table.column("low"), "<u8")[0])
        np.maximum.at(high, of, _segments(table.column("high"), "<u8")[0])
        return _returned(table, 2, (low < high)[of], size)

    sent = blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(emit, "block long, bucket int, keys binary, low binary, high binary")
    return sent.groupBy("bucket").applyInArrow(resolve, FLAGS)


FIRST_RUNS = "gram long, block long, id long, doc int, first long, bytes binary"


def first_runs(blocks: DataFrame, flags: DataFrame) -> DataFrame:
    """The first runs of contested grams, with their bytes."""
    schema = pa.schema([("gram", pa.int64()), ("block", pa.int64()), ("id", pa.int64()), ("doc", pa.int32()), ("first", pa.int64()), ("bytes", pa.binary())])

    def emit(table: pa.Table, other: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        runs, known = Runs(table), _flags(other)
        at = runs.divide(known)[1]
        grams, of = np.unique(runs.gram[at], return_inverse=True)
        at = at[_unpack(known.get(2), len(grams))[of]]
        _, off, data = runs.texts.buffers()
        off = np.frombuffer(off, np.int32)[runs.texts.offset:].astype(np.int64)
        raw = memoryview(data) if data is not None else b""
        start = off[runs.doc[at]] + runs.first[at]
        end = off[runs.doc[at]] + runs.last[at] + LENGTH
        return pa.table([runs.gram[at].view(np.int64), np.full(len(at), table.column("block")[0].as_py()), runs.ids[runs.doc[at]],
                         runs.doc[at].astype(np.int32), runs.first[at], pa.array([bytes(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())], pa.binary())], schema=schema)

    return blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(emit, FIRST_RUNS)


def name(*parts: np.ndarray) -> np.ndarray:
    """Ranks of tuples: equal tuples get equal names, in sorted order."""
    out = parts[0].astype(np.uint64)
    for p in parts[1:]:
        width = int(p.max(initial=0)) + 1
        if (int(out.max(initial=0)) + 1) * width >= 1 << 64:
            out = np.unique(out, return_inverse=True)[1].astype(np.uint64)
        out = out * np.uint64(width) + p.astype(np.uint64)
    return np.unique(out, return_inverse=True)[1].astype(np.uint64)


def lowest_by_string(text: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For the 50-byte strings of `text` at `at` (identifier each): the smallest identifier of an equal one.

    Difference cover modulo 3: positions 1 and 2 (mod 3) are sampled."""
    n = len(text)
    s = np.concatenate([text, np.zeros(128 - n % 3, np.uint8)]).astype(np.uint64)
    whole = len(s) - len(s) % 3
    grid = np.arange(whole)
    sampled = grid[grid % 3 != 0]
    rank = np.zeros(len(s), dtype=np.uint64)
    take = lambda v, i: v[np.minimum(i, len(s) - 1)]
    rank[sampled] = name(s[sampled] << np.uint64(16) | take(s, sampled + 1) << np.uint64(8) | take(s, sampled + 2))
    for step in ((3, 6), (9, 18), (21,)):  # names of 3 bytes make names of 9, 27 and 48
        rank[sampled] = name(rank[sampled], *(take(rank, sampled + k) for k in step))
    out = ids.copy()
    mod = at % 3
    for k, residues in ((0, (1, 2)), (1, (0, 1)), (2, (0, 2))):  # where at + k is sampled
        mine = np.flatnonzero((mod == residues[0]) | (mod == residues[1]))
        if not len(mine):
            continue
        p = at[mine]
        edge = [s[p + i] for i in range(k)] + [s[p + i] for i in range(48 + k, 50)]
        key = name(rank[p + k], edge[0] << np.uint64(8) | edge[1]).astype(np.int64)
        lowest = np.full(int(key.max()) + 1, NO_ID)
        np.minimum.at(lowest, key, ids[mine])
        out[mine] = np.minimum(out[mine], lowest[key])
    return out


SPANS = "block long, docs binary, starts binary, ends binary"


def compare_runs(rows: DataFrame, buckets: int) -> DataFrame:
    """Spans of strings that an equal string of a smaller identifier removes, per block."""

    def resolve(table: pa.Table) -> pa.Table:
        gram, ids = table.column("gram").to_numpy(), table.column("id").to_numpy()
        _, of = np.unique(gram, return_inverse=True)
        lo, hi = np.full(of.max() + 1, NO_ID), np.full(of.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(lo, of, ids)
        np.maximum.at(hi, of, ids)
        table = table.filter(pa.array((lo < hi)[of]))
        raw = table.column("bytes").to_pylist()
        text = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(r) for r in raw], dtype=np.int64)
        strings = size - LENGTH + 1
        run = np.repeat(np.arange(len(raw)), strings)
        inner = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
        at = np.repeat(np.cumsum(size) - size, strings) + inner
        own = table.column("id").to_numpy()[run]
        found = lowest_by_string(text, at, own) < own if len(at) else np.zeros(0, bool)
        start = table.column("first").to_numpy()[run[found]] + inner[found]
        return _spans(table.column("block").to_numpy()[run[found]], table.column("doc").to_numpy()[run[found]], start)

    return rows.groupBy(F.pmod("gram", F.lit(buckets)).alias("bucket")).applyInArrow(resolve, SPANS)


def _spans(block: np.ndarray, doc: np.ndarray, start: np.ndarray) -> pa.Table:
    """Strings as spans per block; successive strings become one span."""
    order = np.lexsort((start, doc, block))
    block, doc, start = block[order], doc[order], start[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (block[1:] != block[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(new)
    end = start[np.append(head[1:], len(start))[:len(head)] - 1] + LENGTH
    block, doc, start = block[head], doc[head], start[head]
    cut = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]) if len(block) else np.zeros(1, int)
    pairs = list(zip(cut[:-1], cut[1:]))
    return pa.table({"block": pa.array([int(block[a]) for a, _ in pairs], pa.int64()), **{
        c: pa.array([v[a:b].astype("<i8").tobytes() for a, b in pairs], pa.binary()) for c, v in (("docs", doc), ("starts", start), ("ends", end))}})


def compare_hot(rows: DataFrame) -> DataFrame:
    """The same for the runs of hot grams, string by string."""
    strings = rows.select("block", "doc", "id", F.col("first"), "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("i"))
    strings = strings.select("block", "doc", "id", (F.col("first") + F.col("i")).alias("start"), F.substring("bytes", F.col("i") + 1, F.lit(LENGTH)).alias("string"))
    lowest = strings.groupBy("string").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("string", "low")
    hits = strings.join(lowest, "string").where("id > low").select("block", "doc", "start")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _spans(*(batch.column(i).to_numpy() for i in range(3))).to_batches()

    return hits.mapInArrow(pack, SPANS)


def apply_spans(blocks: DataFrame, flags: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start, end in bytes), kept (the remaining bytes) of every row."""
    found = flags.select("block", "kind", "bucket", "flags", *[F.lit(None).cast("binary").alias(c) for c in ("docs", "starts", "ends")])
    found = found.unionByName(spans.select("block", F.lit(3).alias("kind"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("flags"), "docs", "starts", "ends"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(table: pa.Table, other: pa.Table) -> pa.Table:
        out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": []}
        runs = Runs(table) if table.num_rows else None
        if runs:
            is_span = np.array(other.column("kind").to_pylist()) == 3
            known = _flags(other.filter(pa.array(~is_span, pa.bool_())) if len(is_span) else other)
            more = other.filter(pa.array(is_span, pa.bool_())) if len(is_span) else other
            at = runs.divide(known)[0]
            cells = [np.concatenate([np.frombuffer(v, "<i8") for v in more.column(c).to_pylist()] or [np.zeros(0, np.int64)]) for c in ("docs", "starts", "ends")]
            doc, start, end = (np.concatenate([x, y]) for x, y in zip((runs.doc[at], runs.first[at], runs.last[at] + LENGTH), cells))
            order = np.lexsort((start, doc))
            doc, start, end = doc[order], start[order], end[order]
            cut = np.searchsorted(doc, np.arange(len(runs.ids) + 1))
            for i, text in enumerate(runs.texts):
                raw = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                for a, b in zip(start[cut[i]:cut[i + 1]].tolist(), end[cut[i]:cut[i + 1]].tolist()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                kept, last = [], 0
                for a, b in merged:
                    kept.append(raw[last:a])
                    last = b
                out["n_bytes"].append(len(raw))
                out["spans"].append([{"start": a, "end": b} for a, b in merged])
                out["kept"].append(b"".join([*kept, raw[last:]]))
        ids = runs.ids_or_null if runs else pa.array([], pa.int64())
        return pa.table({"doc_id": ids, "n_bytes": pa.array(out["n_bytes"], pa.int64()), "spans": pa.array(out["spans"], span_type), "kept": pa.array(out["kept"], pa.binary())})

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, schema)


def remove_repeats(docs: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda d: d, id_col: str = "doc_id", text_col: str = "text",
                   hot_runs: int = HOT_RUNS, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans, kept of every row, passed through `finish` and written to the shared folder."""
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first().n
    n_blocks, buckets = 1 + size // block_bytes, 1 + size // bucket_bytes
    parts = min(n_blocks, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), size // (64 << 20)))
    table = f"suffix_blocks_{uuid.uuid4().hex}"
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_blocks)))
    blocks.repartition(parts, "block").write.bucketBy(parts, "block").option("path", f"{work_dir(spark, 'llm')}/blocks").saveAsTable(table)
    blocks = spark.table(table)
    flags = materialise(repeated_grams(blocks, buckets), "grams")
    flags = flags.unionByName(materialise(covered_runs(blocks, flags, buckets), "runs"))
    flags = flags.unionByName(materialise(contested_grams(blocks, flags, buckets), "contested"))
    first = materialise(first_runs(blocks, flags), "first_runs")
    size = first.agg(F.coalesce(F.sum(F.length("bytes").cast("long")), F.lit(0)).alias("n")).first().n
    hot = materialise(first.groupBy("gram").count().where(F.col("count") > hot_runs).select("gram"), "hot")
    if hot.isEmpty():
        spans = compare_runs(first, 1 + size // RUN_BYTES)
    else:
        spans = compare_runs(first.join(hot, "gram", "left_anti"), 1 + size // RUN_BYTES).unionByName(compare_hot(first.join(hot, "gram", "left_semi")))
    out = materialise(finish(apply_spans(blocks, flags, materialise(spans, "spans"))), "result")
    spark.sql(f"DROP TABLE {table}")
    return out


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests(found: DataFrame) -> DataFrame:
        return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                            F.sha2("kept", 256).alias("kept_sha256"))

    return remove_repeats(documents(spark, sf_dir), digests)
