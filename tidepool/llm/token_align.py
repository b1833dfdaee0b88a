"""Operator 13, alignment of the tokens of two tokenizers over the same bytes.

Every text is encoded by A (a byte-level BPE of `tokenizers`, given space + text) and by B (a
`sentencepiece` model, which puts the space itself).  Where an A token and a B token end at the
same byte is a cut; the cuts divide both token rows into groups, and all A-B occurrence pairs of
a group are linked.

Lockstep merging: the documents of a block of a few MB are advanced together.  One state array
holds for each of them the places in its A and B tokens and the start of its group; a step
compares the ends of both current tokens, advances the one that ends first (both at a cut) and
emits the group that a cut closes, whose two token ranges are its links.  Finished documents are
compacted away.  A long document counts as several rows of the state: it is divided at cuts found
by a search every `LANE` tokens, so the steps of a block do not follow its longest text.

Corpus counts: how many documents hold an id pair linked.  A block states each of its pairs once,
with its number of documents; Spark sums these over the blocks, finds the highest count of each A
id, and joins the answers back by pair.  A frequent pair is one row a block, so no key is hot, and
per-occurrence links never leave their task: a document keeps (pair of its block, times linked).
The links of a group of `LARGE` pairs and more are counted from its distinct ids (products of
their frequencies) and never listed one by one.

Defined cases: null and empty texts, and texts whose joined A or B bytes differ from space + text
(as one that holds U+2581), have no tokens, zeros and ''; null and repeated identifiers are
separate documents, row by row; a very long text is a block of its own; ties for the highest count
are all best; an empty table gives an empty result; columns other than identifier and text are not
read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.packing import ChunkTokenizer
from tidepool.llm.shared import documents, id_and_text, materialise

BLOCK_BYTES = 3 << 20
LANE = 256  # tokens of A after which a cut to divide a document at is looked for
LARGE = 4096
LISTED = 4 << 20  # links listed at once

ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
STATED = ("block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<int>, times array<long>, block_pairs array<long>, block_docs array<int>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """Tokenizer A: ids and bytes of a byte-level BPE file; special tokens in texts are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = spec["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                self.bytes[i] = bytes(byte_of[c] for c in token)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if plain and spec.get("normalizer") is None and not spec["model"].get("ignore_merges"):
            self.encode = lambda text, raw=ChunkTokenizer(path).raw: np.frombuffer(raw(text), "<u4")
        else:  # any other file is left to its library
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self.encode = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """Tokenizer B: ids and bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.encode = lambda text: np.array(model.encode(text), np.uint32)


class Pair:
    """Both tokenizers, with the byte length and the decimal spelling of each id."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_len = np.array([len(x) for x in self.a.bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b.bytes], np.int64)
        digits = [str(i).encode() for i in range(max(len(self.a_len), len(self.b_len)))]
        self.a_at, self.b_at = 0, 2 * len(self.a_len)  # spelt ids: A followed by , or | then B followed by , or ;
        self.spelt = [d + end for n, ends in ((len(self.a_len), (b",", b"|")), (len(self.b_len), (b",", b";"))) for d in digits[:n] for end in ends]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both, or none where the bytes of either are not space + text."""
        none = np.zeros(0, np.uint32)
        if not text:
            return none, none
        whole = " " + text
        want = whole.encode()
        a, b = self.a.encode(whole), self.b.encode(text)
        if b"".join(map(self.a.bytes.__getitem__, a.tolist())) != want or b"".join(map(self.b.bytes.__getitem__, b.tolist())) != want:
            return none, none
        return a, b


class Block:
    """The aligned tokens of some documents, laid end to end: ids, `a_of` and `b_of` (tokens before
    each document), and for each group its token ranges and document."""

    def __init__(self, pair: Pair, texts: list):
        self.pair = pair
        coded = [pair.encode(t) for t in texts]
        self.a = np.concatenate([a for a, _ in coded] or [np.zeros(0, np.uint32)]).astype(np.int64)
        self.b = np.concatenate([b for _, b in coded] or [np.zeros(0, np.uint32)]).astype(np.int64)
        self.a_of = np.cumsum([0] + [len(a) for a, _ in coded])
        self.b_of = np.cumsum([0] + [len(b) for _, b in coded])
        a_hi, b_hi = lockstep(np.cumsum(pair.a_len[self.a]), np.cumsum(pair.b_len[self.b]), self.a_of[1:])
        self.a_hi, self.b_hi = a_hi, b_hi
        self.a_lo, self.b_lo = np.append(0, a_hi)[:-1], np.append(0, b_hi)[:-1]
        self.group_of = np.searchsorted(a_hi, self.a_of, side="right")  # groups before each document
        self.doc = np.repeat(np.arange(len(coded)), np.diff(self.group_of))
        self.links = (a_hi - self.a_lo) * (b_hi - self.b_lo)

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups, spelt a1,a2|b1;a3|b2,b3 in decimal; '' without tokens."""
        n_a, n_b = len(self.a), len(self.b)
        a_last, b_last = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        a_last[self.a_hi - 1] = 1
        b_last[self.b_hi - 1] = 1
        codes = np.empty(n_a + n_b, np.int64)
        codes[np.arange(n_a) + self.b_lo[np.cumsum(a_last) - a_last]] = self.pair.a_at + 2 * self.a + a_last
        codes[np.arange(n_b) + self.a_hi[np.cumsum(b_last) - b_last]] = self.pair.b_at + 2 * self.b + b_last
        before, spelt = self.a_of + self.b_of, self.pair.spelt.__getitem__
        return [hashlib.sha256(b"".join(map(spelt, codes[p:q].tolist()))[:-1]).hexdigest() if q > p else ""
                for p, q in zip(before, before[1:], strict=False)]

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair of ids, times) for each distinct linked id pair of each document, by document."""
        found = []
        small = np.flatnonzero(self.links < LARGE)
        before = np.cumsum(self.links[small])
        start = 0
        while start < len(small):
            done = before[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(before, done + LISTED, side="right")))
            found.append(self._listed(small[start:stop]))
            start = stop
        for g in np.flatnonzero(self.links >= LARGE):
            ua, ca = np.unique(self.a[self.a_lo[g]:self.a_hi[g]], return_counts=True)
            ub, cb = np.unique(self.b[self.b_lo[g]:self.b_hi[g]], return_counts=True)
            key = ((ua[:, None] << 32) | ub[None, :]).ravel()
            found.append((np.full(len(key), self.doc[g]), key, (ca[:, None] * cb[None, :]).ravel()))
        if len(found) == 1:
            return found[0]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        doc, key, times = (np.concatenate(x) for x in zip(*found, strict=True))
        return _distinct(doc, key, times)

    def _listed(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        links = self.links[groups]
        of = np.repeat(groups, links)
        place = np.arange(len(of)) - np.repeat(np.cumsum(links) - links, links)
        wide = (self.b_hi - self.b_lo)[of]
        key = (self.a[self.a_lo[of] + place // wide] << 32) | self.b[self.b_lo[of] + place % wide]
        return _distinct(self.doc[of], key, None)


def _distinct(doc: np.ndarray, key: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (document, key) once, documents in order, with its number of rows or the sum of its `times`."""
    code, keys = pd.factorize(key)
    both, kept = pd.factorize(doc * len(keys) + code)
    if times is None:
        total = np.bincount(both, minlength=len(kept))
    else:
        total = np.zeros(len(kept), np.int64)
        np.add.at(total, both, times)
    doc, code = kept // max(1, len(keys)), kept % max(1, len(keys))
    order = np.argsort(doc, kind="stable")
    return doc[order], keys[code[order]], total[order]


def lockstep(a_end: np.ndarray, b_end: np.ndarray, doc_stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B before each cut, ascending.  `a_end`, `b_end`: ends of the tokens in the
    bytes of all documents laid end to end; `doc_stop`: tokens of A before the end of each document."""
    if not len(a_end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.unique(np.concatenate([[0], doc_stop, _lanes(a_end, b_end)]))
    starts = starts[starts < len(a_end)]
    b_starts = np.searchsorted(b_end, a_end[starts - 1], side="right")
    b_starts[0] = 0
    state = np.stack([starts, b_starts, np.append(starts[1:], len(a_end))])  # place in A, place in B, end in A
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    while state.shape[1]:
        i, j, stop = state
        ea, eb = a_end[i], b_end[j]
        cut = ea == eb
        a_cut[i[cut]] = True
        b_cut[j[cut]] = True
        i += ea <= eb
        j += eb <= ea
        going = i < stop
        if not going.all():
            state = state[:, going]
    return np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1


def _lanes(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Tokens of A before a cut, about one every LANE tokens, where one is found within LANE tokens."""
    open_ = np.arange(LANE, len(a_end), LANE)
    found = []
    for ahead in range(LANE):
        if not len(open_):
            break
        at = open_ + ahead - 1
        at, open_ = at[at < len(a_end)], open_[at < len(a_end)]
        place = np.searchsorted(b_end, a_end[at])
        hit = b_end[np.minimum(place, len(b_end) - 1)] == a_end[at]
        found.append(at[hit] + 1)
        open_ = open_[~hit]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], pair: Pair) -> Iterator[tuple[list, Block]]:
    """(identifiers, block) of runs of rows of about BLOCK_BYTES of text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        col = batch.column("text")
        doc_ids = batch.column("doc_id").to_pylist()
        for lo, hi, data, _ in T.slices(col, BLOCK_BYTES):
            if texts and size + len(data) > BLOCK_BYTES:
                yield ids, Block(pair, texts)
                ids, texts, size = [], [], 0
            ids += doc_ids[lo:hi]
            texts += col[lo:hi].to_pylist()
            size += len(data)
    if texts:
        yield ids, Block(pair, texts)


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, a_cuts, b_cuts: the ids of both tokenizers and the tokens of each before
    every cut, so that group k is A tokens a_cuts[k-1]..a_cuts[k] and B tokens b_cuts[k-1]..b_cuts[k]."""
    paths = _paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*paths)
        for ids, block in _blocks(batches, pair):
            a_cuts, b_cuts = block.a_hi - block.a_of[block.doc], block.b_hi - block.b_of[block.doc]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), _lists(block.a, block.a_of, pa.int32()), _lists(block.b, block.b_of, pa.int32()),
                _lists(a_cuts, block.group_of, pa.int32()), _lists(b_cuts, block.group_of, pa.int32())],
                names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    return id_and_text(docs, id_col, text_col).mapInArrow(T.task(run), ALIGNED)


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if a_path and b_path:
        return a_path, b_path
    a, b = default_paths()
    return a_path or a, b_path or b


def linked_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
                 b_path: str | None = None) -> DataFrame:
    """Written table STATED: a row for each document (its figures, and its linked id pairs as places in its
    block's list), and one for each block (block_pairs: A id << 32 | B id, block_docs: documents holding each)."""
    paths = _paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*paths)
        number = TaskContext.get().partitionId() << 32
        for ids, block in _blocks(batches, pair):
            yield _stated(number, ids, block)
            number += 1

    return materialise(id_and_text(docs, id_col, text_col).mapInArrow(T.task(run), STATED), "linked")


def _stated(number: int, ids: list, block: Block) -> pa.RecordBatch:
    n = len(ids)
    doc, key, times = block.linked()
    code, keys = pd.factorize(key)
    held = np.bincount(code, minlength=len(keys))
    links = np.append(0, np.cumsum(block.links))[block.group_of]
    off = np.searchsorted(doc, np.arange(n + 1))
    end = np.append(off, off[-1])  # the block's own row has no pairs of a document
    none = np.zeros(n + 1, np.int64)
    longs = [np.diff(block.a_of), np.diff(block.b_of), np.diff(block.group_of), np.diff(links)]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + 1, number), pa.int64()), pa.array([*range(n), None], pa.int32()), pa.array([*ids, None], pa.int64()),
        *[pa.array(np.append(x, 0), pa.int64()) for x in longs], pa.array([*block.digests(), None], pa.string()),
        _lists(code, end, pa.int32()), _lists(times, end, pa.int64()),
        _lists(keys, np.append(none, len(keys)), pa.int64()), _lists(held, np.append(none, len(keys)), pa.int32())],
        names=[f.split()[0] for f in STATED.split(", ")])


def pair_counts(stated: DataFrame) -> DataFrame:
    """pair, total (documents that hold it linked), best (no pair of its A id is held by more)."""
    counts = _cells(stated).groupBy("pair").agg(F.sum("docs").alias("total"))
    return counts.withColumn("best", F.col("total") == F.max("total").over(W.partitionBy(F.shiftright("pair", 32))))


def _cells(stated: DataFrame) -> DataFrame:
    listed = stated.where("row IS NULL").select("block", F.posexplode(F.arrays_zip("block_pairs", "block_docs")).alias("place", "cell"))
    return listed.select("block", "place", F.col("cell.block_pairs").alias("pair"), F.col("cell.block_docs").alias("docs"))


def alignment_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
                     b_path: str | None = None) -> DataFrame:
    """The figures of each document (columns RESULT), corpus-wide pair counts included."""
    stated = linked_pairs(docs, id_col, text_col, a_path, b_path)
    answers = _cells(stated).join(pair_counts(stated), "pair").select(F.col("block").alias("of"), "place", "total", "best")
    rows = stated.where("row IS NOT NULL").drop("block_pairs", "block_docs")
    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_answered, RESULT)


def _answered(rows: pa.Table, answers: pa.Table) -> pa.Table:
    total, best = np.zeros(len(answers), np.int64), np.zeros(len(answers), np.int64)
    place = answers.column("place").to_numpy()
    total[place] = answers.column("total").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    pairs = rows.column("pairs").combine_chunks()
    times = rows.column("times").combine_chunks().flatten().to_numpy()
    size = np.append(0, np.cumsum(pairs.value_lengths().to_numpy()))
    at = pairs.flatten().to_numpy()
    sums = [np.diff(np.append(0, np.cumsum(x[at] * times))[size]) for x in (best, total)]
    names = [f.split()[0] for f in RESULT.split(", ")]
    made = dict(zip(("n_best", "count_sum"), (pa.array(x, pa.int64()) for x in sums), strict=True))
    return pa.table([made[c] if c in made else rows.column(c) for c in names], names=names)


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(documents(spark, sf_dir))
