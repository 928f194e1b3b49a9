"""Byte-level text kernels in numpy: slices of Arrow string columns, word boundaries, word and
shingle hashes. Memory follows the slice size, not the partition.

A word hash is a 64-bit polynomial hash over (lower-cased) UTF-8 bytes, finished by a mixer; equal
words hash equally, and unequal ones collide with probability about 2**-64.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)


def byte_class(pred) -> np.ndarray:
    """A 256-entry table: whether a (lower-cased) byte belongs to a word."""
    return np.array([bool(pred(b)) for b in range(256)])


#: words are runs of anything but space and \x09-\x0D
SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: words are runs of 0-9, a-z and everything beyond ASCII
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return run(_BASE), run(_INV)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 2 * SLICE_BYTES
    while size < n + 1:
        size *= 2
    return _powers(size)


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of runs of rows with about ``limit`` bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def _words_of(low: np.ndarray, table: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in ``low``; no word crosses a position in ``cuts``."""
    inside = table[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(low))
    total = _BYTES[low]
    total *= up[:len(low)]
    np.cumsum(total, out=total)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0)) if len(starts) else np.zeros(0, np.uint64)
    h = (total[ends - 1] - before) * down[starts] if len(starts) else before
    return starts, ends, mix(h + (ends - starts).astype(np.uint64) * _MUL)


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray, segment: int = 4 * SLICE_BYTES):
    """(lower-cased bytes, word starts, word ends, word hashes, words before each row) of a slice.

    A slice of one very long text is worked through in segments cut between words."""
    low = _LOWER[buf]
    if len(low) <= segment:
        starts, ends, h = _words_of(low, table, offs)
    else:
        parts, at = [], 0
        while at < len(low):
            cut = min(at + segment, len(low))
            while cut < len(low) and table[low[cut]]:
                gaps = np.flatnonzero(~table[low[cut:cut + segment]])
                cut = cut + int(gaps[0]) if len(gaps) else min(cut + segment, len(low))
            s, e, x = _words_of(low[at:cut], table, offs - at)
            parts.append((s + at, e + at, x))
            at = cut
        starts, ends, h = (np.concatenate(p) for p in zip(*parts))
    return low, starts, ends, h, np.searchsorted(starts, offs)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (those across rows are the caller's to skip)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = h[:n].copy()
    for i in range(1, size):
        x *= _MUL
        x += h[i:i + n]
        x = mix(x)
    return mix(x + np.uint64(size))


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
