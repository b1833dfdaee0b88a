"""Operator 4, best-fit packing by the sum-of-squares rule.

Tokenisation (`token_pieces`) runs over Arrow batches; the ids come back as binary, so the JVM
can digest or store them.  A single space between two non-space characters always starts a new
pre-token of this byte-level BPE, so a text is the concatenation of its space-separated chunks
and the ids of a chunk are kept in a bounded table per worker.  Texts where a space touches
other white space are encoded whole, and texts that hold an added token of the file by the
`tokenizers` library itself.

Packing (`pack`) deals the pieces by hash to groups of about 65,536 pieces (their number grows
with the input), so a task holds one bounded group.  Inside a group pieces go longest first to
the bin (open, or new) for which the sum over residual gaps of the squared count of open bins
with that gap becomes smallest; ties go to the smallest gap.

Defined cases: null text is the empty text (one piece, the end id alone); null and repeated
identifiers are separate documents, row by row; an empty table gives an empty result; ties in
length are ordered by identifier, piece and digest of the row; other columns of the pieces pass
through `pack`, and those of the documents are not read.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import textops as T
from tidepool.llm.shared import documents, id_and_text, materialise

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 65_536
KEPT_CHUNKS = 400_000  # ids of so many chunks are kept per worker; then the table starts anew

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ranked(path: str):
    """The vocabulary of a byte-level BPE `tokenizers` file as a tiktoken encoding (same ids, about
    five times the speed): ranks are the ids, as for every GPT-2 style file."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ChunkTokenizer:
    """Whole texts without added tokens to little-endian uint32 ids, chunk by chunk."""

    def __init__(self, path: str):
        import regex

        self._encode = _ranked(path).encode_ordinary
        self._unsafe = regex.compile(r" \s|\s | \Z|\A ").search
        self._kept: dict[str, bytes] = {}

    def _new(self, chunk: str) -> bytes:
        if len(self._kept) >= KEPT_CHUNKS:
            self._kept.clear()
        out = self._kept[chunk] = self.raw(" " + chunk)
        return out

    def raw(self, text: str) -> bytes:
        ids = array("I", self._encode(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __call__(self, text: str) -> bytes:
        if self._unsafe(text):
            return self.raw(text)
        head, *rest = text.split(" ")
        kept, new = self._kept, self._new
        return self.raw(head) + b"".join([kept[c] if c in kept else new(c) for c in rest])


class TextTokenizer:
    """The ids of `tokenizers`' own encode(text, add_special_tokens=False).  Its added tokens are cut
    out of a text before anything else; a text that holds one is encoded by the library itself."""

    def __init__(self, path: str):
        import json

        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        always = spec.get("normalizer") is not None and any(t["normalized"] for t in added)  # found in other spellings too
        self._added = regex.compile("" if always else "|".join(regex.escape(t["content"]) for t in added) or r"(?!)").search
        self._path, self._library = path, None
        self._plain = ChunkTokenizer(path)

    def __call__(self, text: str) -> bytes:
        if not self._added(text):
            return self._plain(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (uint32 little-endian): each document's ids and an end id,
    cut into pieces of `capacity` ids, of which the first may be shorter, if there are more."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextTokenizer(path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids"]
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if at == 0 else capacity
                    for out, v in zip(rows, (doc, piece, at, size, ids[4 * at:4 * (at + size)])):
                        out.append(v)
                    at, piece = at + size, piece + 1
                held += len(ids)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, TYPES)], names)
                    rows, held = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, TYPES)], names)

    TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return id_and_text(docs, id_col, text_col).mapInArrow(T.task(cut), PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, placed in the order given."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by residual gap
    count = np.zeros(capacity + 1, dtype=np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n_bins = 0
    for i, size in enumerate(lengths.tolist()):
        # change of the sum if a bin of gap g >= size gets the item; closed bins (gap 0) do not count
        change = 2 * (count[:capacity + 1 - size] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change = np.where(count[size:] > 0, change, np.iinfo(np.int64).max)
        j = int(change.argmin())
        rest = capacity - size
        fresh = 2 * count[rest] + 1 if rest else 0
        if count[j + size] and change[j] <= fresh:
            gap = j + size
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > size:
            open_bins[gap - size].append(b)
            count[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """`pieces` (doc_id, piece, length and any others) with sequence_id and offset added.  Run it on a
    written table: the pieces are counted first, for the number of groups."""
    groups = max(1, -(-pieces.count() // group_rows))
    others = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    dealt = pieces.select(*others).withColumn("_group", F.pmod(F.xxhash64(*[F.col(c) for c in others]), F.lit(groups)))

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), *[(c, "ascending") for c in others if c != "length"]])
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        first = key[0].as_py() << 32
        return table.select(others).append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    schema = dealt.select(*others).schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Placement of every piece with the digest of its ids."""
    pieces = token_pieces(docs, tokenizer=tokenizer, capacity=capacity)
    pieces = materialise(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, capacity)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
