import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from tidepool.llm import packing as P
from tidepool.llm.shared import documents


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def pieces_of(rows, tokenizer, capacity):
    """(doc_id, piece, start, length, crc) of every document by the reference tokenizer."""
    out = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return out


def check_layout(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pieces_and_layout(edge_docs, edge_rows, tokenizer, capacity):
    got = P.pack_documents(edge_docs, capacity=capacity).collect()
    want = pieces_of(edge_rows, tokenizer, capacity)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    n = check_layout(got, capacity)
    assert n <= 1.1 * -(-sum(r.length for r in got) // capacity) + 1


def test_ids_of_all_documents_and_round_trip(spark, tokenizer):
    docs = documents(spark, SF001)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    pieces = P.token_pieces(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in pieces) == pieces_of(rows, tokenizer, 2048)
    ids = defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        ids[r.doc_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert all(tokenizer.decode(ids[i][:-1], skip_special_tokens=False) == t for i, t in rows)


@pytest.mark.parametrize("text", ["", " ", "  a", "a ", "a  b", "a \n b", "a  b c", "x  y", "don't we'll  stop", "<|endoftext|> x", "1 22 333,4", "é è\tü"])
def test_chunks_give_the_ids_of_the_whole_text(tokenizer, text):
    encode = P.ChunkTokenizer(P.default_tokenizer())
    assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_get_their_own_ids(make):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "a <|endoftext| b", "no such token", "", None]))
    assert 50256 in library.encode(rows[0][1], add_special_tokens=False).ids
    got = P.pack_documents(make(rows)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_of(rows, library, 2048)


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 33, 400)
    bins, offsets = P.sum_of_squares(lengths, 32)
    fill, order = {}, []
    for size, b, at in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        def cost(levels):
            return sum(v * v for v in Counter(32 - f for f in levels if f < 32).values())
        options = {None: cost([*fill.values(), size])} | {f: cost(_moved(fill.values(), f, size)) for f in set(fill.values()) if f + size <= 32}
        chosen = None if b not in fill else fill[b]
        assert options[chosen] == min(options.values()) and at == fill.get(b, 0)
        fill[b] = fill.get(b, 0) + size
        order.append(b)


def _moved(levels, f, size):
    levels = list(levels)
    levels.remove(f)
    return [*levels, f + size]


def test_groups_and_other_columns(spark):
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 50 + 1).alias("length"),
                                     F.lit(None).cast("string").alias("sequence_id"), F.lit("z").alias("note"))
    rows = P.pack(pieces, 64, group_rows=100).collect()
    assert len(rows) == 500 and {r.note for r in rows} == {"z"}
    check_layout(rows, 64)


def test_empty_table(no_docs):
    assert P.pack_documents(no_docs).collect() == []
