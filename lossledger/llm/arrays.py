"""Vectorized helpers on bytes, words and 64-bit hashes, used inside Arrow batches.

All arithmetic is modulo 2**64. A word's hash depends on its bytes only, so tasks agree on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once, unless one text alone is longer.
SLICE = 1_000_000
# Bytes that share one table of powers.
SEGMENT = 1 << 20

_BASE = 0x9E3779B97F4A7C55
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, np.uint64(factor))
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _TABLES[base] = (tables[0], tables[1])
    up, down = _TABLES[base]
    return up[:n], down[:n]


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for consecutive rows; nulls count as empty."""
    column = pc.fill_null(column.cast(pa.binary()).cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
    # Arrow keeps freed batches for itself; a worker that lives on would hold the most it ever did.
    pa.default_memory_pool().release_unused()


def split_words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACES):
    """(starts, ends, first word of each text and one past the last): maximal runs of bytes that
    ``gaps`` does not mark; none crosses from one text into the next."""
    inside = ~gaps[data]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        size = int(ends[b - 1]) - low
        up, down = powers(_BASE, size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[low:low + size].astype(np.uint64) + np.uint64(1)) * up[:size],
                  out=total[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _GOLDEN
        a = b
    return mix(out)


def word_hashes(data, offsets, fold: np.ndarray = AS_IS, gaps: np.ndarray = SPACES):
    """(starts, ends, bounds, hashes) of the words of several texts, bytes folded by a table."""
    starts, ends, bounds = split_words(data, offsets, gaps)
    return starts, ends, bounds, hash_spans(fold[data], starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words, whatever text they are in."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, _ = powers(_WORD_BASE, n)
    size = len(words) - n + 1
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out += words[j:j + size] * up[j]
    return mix(out)


class RangeHash:
    """Hashes of any ranges of a word sequence, each in constant time."""

    def __init__(self, words: np.ndarray, base: int = _WORD_BASE):
        self.up, self.down = powers(base, len(words) + 1)
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.up[:len(words)], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        span = (self.total[end] - self.total[start]) * self.down[start]
        return mix(span + (end - start).astype(np.uint64) * _GOLDEN)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For every start, where the first of the smallest of ``width`` consecutive values is."""
    at = np.arange(len(values))
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        covered += step
    return at


def changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any column; the first row does."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)`` of every pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the bounds of each row."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by one space."""
    if not len(starts):
        return b""
    size = ends - starts
    out = np.full(int(size.sum()) + len(size) - 1, 32, np.uint8)
    at = np.cumsum(size + 1) - size - 1
    out[ranges(at, size)] = data[ranges(starts, size)]
    return out.tobytes()
