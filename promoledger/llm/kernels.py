"""Numpy kernels over the bytes of a batch of texts, used inside Spark tasks.

A batch is the data buffer of an Arrow string column with its row offsets, so nothing is decoded or
copied per row. Words are maximal runs of bytes other than space and tab to carriage return.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U = np.uint64
_SEED, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_C1, _C2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * _C1
    x ^= x >> U(33)
    x *= _C2
    x ^= x >> U(33)
    return x


_TABLE = mix(np.arange(1, 257, dtype=U) * U(_SEED))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0..n of an odd factor and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


class RangeHash:
    """Hash of any byte range of a batch in constant time per range."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _power_tables(len(data))
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(_TABLE[data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U) * U(_SEED))

    def every(self, size: int) -> np.ndarray:
        """Hash of every range of ``size`` bytes, by start."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n] + U(size * _SEED % (1 << 64)))


def combine(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for an ordered tuple of hashes."""
    out = hashes[0]
    for h in hashes[1:]:
        out = mix(out * U(_STEP) + h)
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULL rows are empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), off


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of row ranges near ``limit`` bytes; one row may exceed it."""
    data, off = text_buffer(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a task's batches; at its end the worker keeps no freed memory."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def word_ranges(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    space = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    before |= edge[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after |= edge[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def repeats(keys: np.ndarray) -> np.ndarray:
    """True where a key equals one at an earlier position."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def total_per(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive bounds."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
