"""Words, lines and their 64-bit hashes, computed for a whole Arrow column of texts at once.

Text is handled as UTF-8 bytes. White space is one of the six bytes 0x20 and 0x09-0x0D; no byte of a longer
character is one of them. Hashes are polynomials over a fixed table of random values, finished by a mixing
step; they are the same in every process. A polynomial modulo 2**64 is weak on long strings of a regular kind, so
stretches over POLYNOMIAL_BYTES are hashed by xxhash. Two different strings that nobody chose for it get one hash with
a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_LIBC = ctypes.CDLL(None)
SLICE_BYTES = 1 << 20
POLYNOMIAL_BYTES = 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows with about `limit` bytes together: first row, bytes, offsets of the rows in them.

    A null counts as the empty text. A text longer than `limit` is a run of its own, whole.
    """
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "") if column.null_count else column
    n = len(column)
    if not n:
        return
    _, places, content = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(places, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def give_back() -> None:
    """Give the memory that this process holds in reserve back.

    Both reserves: that of Arrow, and that of the C library, which keeps what freed arrays leave.
    """
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # GNU only
        _LIBC.malloc_trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; behind the last, the worker gives its reserves of memory back."""
    try:
        yield from batches
    finally:
        give_back()


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the longest stretches without a break; the end of a row breaks too."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~breaks
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= breaks[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= breaks[1:] | edge[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words."""
    return spans(data, offsets, SPACE[data])


def _power_tables(n: int) -> list[np.ndarray]:
    """The first `n` powers of the base and of its inverse; tables over the usual size are not kept."""
    if len(_powers[0]) >= n:
        return _powers
    tables = []
    for base in (_BASE, _INVERSE):
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        tables.append(np.cumprod(steps))
    if n <= SLICE_BYTES + 1:
        _powers[:] = tables
    return tables


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes."""
    n = len(data) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n, np.uint64)
    np.cumsum(_TABLE[data] * up[: n - 1], out=sums[1:])
    out = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    long = np.flatnonzero(end - start > POLYNOMIAL_BYTES)
    if len(long):
        whole = data.tobytes()
        ends = zip(start[long].tolist(), end[long].tolist(), strict=True)
        out[long] = np.array([xxhash.xxh64_intdigest(whole[a:b]) for a, b in ends], np.uint64)
    return out


def windows(hashed: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of `size` words that lies within one row, in order."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashed[k : k + n]
    whole = rows[:n] == rows[size - 1 :]
    return mix(out[whole]), rows[:n][whole]


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sums by row, as 64-bit integers (weights are whole numbers)."""
    return np.bincount(rows, weights, n).astype(np.int64)
