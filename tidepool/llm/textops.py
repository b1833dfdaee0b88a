"""Vectorised text primitives over Arrow string columns (numpy, inside Spark tasks).

A column is cut into slices of a few MB of UTF-8 bytes (a longer document is a slice of its
own), so memory follows the slice, not the Arrow batch.  Words are found with byte masks and
hashed to 64 bits by a prefix-sum polynomial, without a Python loop per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

# Byte classes.  SPACE: the separators x20, x09-x0D.  ALNUM words: 0-9, A-Z, a-z and all
# non-ASCII bytes.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE[LOWER]
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept and doubled as needed)."""
    have = _powers.get(hex(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        have = _powers[hex(base)] = np.multiply.accumulate(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of at most `max_bytes` (or one row)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a, n = 0, len(col)
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and `first`: words of row i are first[i]:first[i+1]."""
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(off), np.int64)
    inside = is_word[data]
    change = np.empty(n + 1, dtype=bool)
    np.not_equal(inside[1:], inside[:-1], out=change[1:n])
    change[0], change[n] = inside[0], inside[-1]
    edges = np.flatnonzero(change)
    starts, ends = edges[0::2], edges[1::2]
    cuts = off[1:-1]  # a word that runs over a row border is two words
    cuts = cuts[(cuts > 0) & (cuts < n)]
    if len(cuts):
        cuts = np.unique(cuts)
        cuts = cuts[inside[cuts] & inside[cuts - 1]]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, ASCII-lower-cased if `lower`."""
    n = len(data)
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * _power(_R, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_R_INV, n + 1)[starts])


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (len(h) - k + 1 of them)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j:len(h) - k + 1 + j]
    return mix(out)


def spread(first: np.ndarray) -> np.ndarray:
    """Row number of each word, from `first` of word_spans."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def release() -> None:
    """Give memory that is free back to the system.  Python workers serve task after task, and what the
    allocators keep of a task's arrays would count against the executor for as long as they live."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to give back by hand
        pass


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that releases its memory when its task ends."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole
