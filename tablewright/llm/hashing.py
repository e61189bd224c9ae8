"""Words of texts as arrays: ASCII white space separates, A-Z are lowered, every word gets a 64-bit hash.

The functions run inside Arrow tasks. They take whole columns, never a prefix, and work through the
bytes in pieces of a few MB, so that memory does not depend on the length of a text.
Two different words share a hash with a chance of about 2 ** -64 per pair compared.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits; one to one."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(21, (n - 1).bit_length())
        steps = np.full(size, _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * PIECE_BYTES:
            _powers[kind] = have
    return have[:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in a row, and the bounds of its rows. NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, bounds, data = column.buffers()
    places = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 2 * PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        row = 0
        while row < len(sizes):
            before = ends[row] - sizes[row]
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(row, stop - row)
            row = stop
    release_memory()


def release_memory() -> None:
    """Give freed memory back: workers live on after a task, beside an executor that may need it for shuffles."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of each byte span; spans must be ascending and must not overlap."""
    out = np.empty(len(starts), np.uint64)
    table = _LOWERED if lower else _BYTE
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + PIECE_BYTES, "right")))
        sums = np.empty(ends[j - 1] - begin + 1, np.uint64)
        sums[0] = 0
        np.multiply(table[data[begin : ends[j - 1]]], _power("up", len(sums) - 1), out=sums[1:])
        np.cumsum(sums, out=sums)
        s, e = starts[i:j] - begin, ends[i:j] - begin
        down = _power("down", len(sums))
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the place of its first word (one more at the end)."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    space = SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    before |= cut[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    after |= cut[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lowered words of all rows in a row, and the bounds of each row among them."""
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds)
    return span_hashes(data, starts, ends, lower=True), first


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Ascending distinct hashes of all runs of ``size`` words; of the whole sequence where it is shorter."""
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    factor = 1
    for k in range(width):
        factor = factor * 0xA0761D6478BD642F + 2 * k + 1 & 2**64 - 1 | 1
        total += words[k : k + len(total)] * np.uint64(factor)
    return np.unique(mix(total + np.uint64(width)))
