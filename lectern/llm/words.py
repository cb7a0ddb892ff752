"""Words of Arrow text columns as numpy arrays: bounds, hashes and document ranges.

A task reads text as bytes and never makes a Python string for a word. Word
identity is a 64-bit hash (polynomial over the bytes, then mixed); two of a
million distinct words collide with probability below 1e-7.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a worker holds as arrays at once; one longer document still comes whole.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    kind = np.ones(256, bool)
    kind[[0x20, 9, 10, 11, 12, 13]] = False
    return kind


def alphanumeric() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, for lower-cased text."""
    kind = np.zeros(256, bool)
    kind[0x30:0x3A] = kind[0x61:0x7B] = kind[0x80:] = True
    return kind


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; n values."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Texts(NamedTuple):
    """Some rows of a batch: their record batch, the bytes of their texts and the rows' bounds in them."""

    rows: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Bounds in bytes and hashes of all words; row r has words first[r] to first[r + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def release() -> None:
    """Give memory that is no longer used back to the system: idle workers stay alive beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[Texts]:
    """The batches in slices of about ``size`` bytes of text. A null text is an empty one."""
    for batch in batches:
        col = pc.fill_null(batch.column(column), "")
        n = len(col)
        if not n:
            continue
        wide = pa.types.is_large_string(col.type)
        _, offsets, values = col.buffers()
        bounds = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, col.offset * (8 if wide else 4)).astype(np.int64)
        data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
        start = 0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
            yield Texts(batch.slice(start, stop - start), data[bounds[start] : bounds[stop]], bounds[start : stop + 1] - bounds[start])
            start = stop
    release()


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32)


def split(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray, hashed: bool = True) -> Words:
    """Words of each row: runs of bytes of the kind, never across rows."""
    inside = kind[data]
    before = np.zeros(len(data), bool)
    after = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = False
    after[bounds[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, bounds)
    return Words(starts, ends, span_hashes(data, starts, ends) if hashed else np.zeros(0, np.uint64), first)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes in each span, alike wherever the span stands."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts])


def gram_hashes(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray | int) -> np.ndarray:
    """64-bit hashes of word sequences: of ``counts`` words from each of ``starts``."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), out=sums[1:])
    value = (sums[starts + counts] - sums[starts]) * powers(_INVERSE, len(hashes) + 1)[starts]
    return mixed(value + np.asarray(counts, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [first, stop), end to end, and the number of the range of each."""
    size = np.maximum(stop - first, 0)
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size), of


def longs(x: np.ndarray) -> pa.Array:
    """Hashes as signed longs, the form in which Spark keeps them."""
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def lists(values: pa.Array, first: np.ndarray) -> pa.ListArray:
    """Rows of lists: row r holds values first[r] to first[r + 1]."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)
