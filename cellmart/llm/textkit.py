"""Whole-column text helpers used inside Spark tasks.

An Arrow string column is one UTF-8 byte buffer plus offsets. The helpers below look at that
buffer as a numpy array and work on all documents of a block at once, so no Python code runs
per word. Blocks are bounded in bytes (``BLOCK_BYTES``); a document longer than a block is a
block of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

# Multipliers of the 64-bit polynomial hashes (odd, so they have an inverse modulo 2**64).
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)

# The tables of powers grow in whole steps.
_STEP = 1 << 18
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and ``_BASE**-i`` modulo 2**64 for ``i < n`` (kept per process)."""
    if len(_POWERS["up"]) < n:
        size = -(-n // _STEP) * _STEP
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes so that all their bits depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the ``n + 1`` offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def release() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blocks(column, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Split a column into runs of rows of at most ``limit`` bytes (one row at least):
    (first row, bytes, offsets). Memory is given back after the last one."""
    data, off = column_bytes(column)
    row, n = 0, len(off) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        yield row, data[off[row]:off[last]], off[row:last + 1] - off[row]
        row = last
    release()


def lower_ascii() -> np.ndarray:
    """Byte table that maps A-Z to a-z and leaves every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def non_space() -> np.ndarray:
    """Bytes of words cut at ASCII white space (space and 09-0D)."""
    keep = np.ones(256, bool)
    keep[[0x20, *range(0x09, 0x0E)]] = False
    return keep


def alphanumeric() -> np.ndarray:
    """Bytes of words made of digits, a-z and all non-ASCII characters."""
    keep = np.zeros(256, bool)
    keep[0x30:0x3A] = True
    keep[0x61:0x7B] = True
    keep[0x80:] = True
    return keep


def spans(data: np.ndarray, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the maximal runs of kept bytes; runs never cross rows."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = keep[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hashes`` turns two of them into the hash of a span."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, off: np.ndarray, keep: np.ndarray, fold: np.ndarray):
    """Words of a block: (hashes, start bytes, end bytes, first word of each row + total)."""
    folded = fold[data]
    starts, ends = spans(folded, off, keep)
    return span_hashes(prefix_sums(folded), starts, ends), starts, ends, np.searchsorted(starts, off)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row, in text order, and the first one of each
    row. A row with fewer words (but not none) has one shingle: its whole word sequence."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(n)), count)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    length = np.minimum(n[row], k)
    out = length.astype(np.uint64)
    for i in range(k):
        here = i < length
        out = np.where(here, out * _WORD_BASE + words[np.where(here, at + i, 0)], out) if len(words) else out
    return mix(out), begin


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``first[i], ..., first[i] + count[i] - 1``."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(count) - count
    return np.repeat(first - begin, count) + np.arange(total)
