"""Helpers for Arrow functions over text: bounded slices, flat UTF-8 bytes, rolling hashes.

All functions work on one Arrow batch inside a task. Memory is bounded by the
slice size, or by one row where a single text is larger than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)


def bounds(column: pa.Array) -> np.ndarray:
    """Byte offsets of the rows of a string or binary array without nulls, from 0."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in one array, and the offsets of the rows in it."""
    at = bounds(column)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def filled(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls read as empty texts."""
    column = batch.column(name)
    return pc.fill_null(column, "") if column.null_count else column


def slices(
    batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches, each with its text column; ``limit`` bytes of text each, or a single row."""
    for batch in batches:
        texts = filled(batch, name)
        at = bounds(texts)
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(at, at[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE (or its inverse) to the powers 0 to n-1, modulo 2**64."""
    return (_kept_powers(inverse) if n <= SLICE_BYTES + 1 else _powers(n, inverse))[:n]


@lru_cache
def _kept_powers(inverse: bool) -> np.ndarray:
    """As many as a slice needs; 8 MB a worker."""
    out = _powers(SLICE_BYTES + 1, inverse)
    out.flags.writeable = False
    return out


def _powers(n: int, inverse: bool) -> np.ndarray:
    """The first n powers, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    step, have = (_INVERSE if inverse else BASE), 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step)
        step = step * step & _MASK
        have += more
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all bits of a hash depend on all bits of its input."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * BASE**position modulo 2**64, with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    terms = np.add(values, np.uint64(1), dtype=np.uint64)
    terms *= powers(len(values))
    np.cumsum(terms, out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range [start, end): equal for equal content, wherever it stands."""
    return mixed((prefix[ends] - prefix[starts]) * powers(len(prefix), inverse=True)[starts])


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hashes(values)
    return mixed((prefix[width:] - prefix[:n]) * powers(n, inverse=True))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def words(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of flat text, and the row each stands in; ``table``: byte is part of a word."""
    inside = table[data]
    # where a word can begin or end: an edge of a row, or a byte before or behind that is part of none
    free = np.ones(len(data) + 1, bool)
    np.logical_not(inside[:-1], out=free[1:-1])
    free[at] = True
    starts = np.flatnonzero(inside & free[:-1])
    free[:-2] = ~inside[1:]
    free[-2:] = True
    free[at[at > 0] - 1] = True
    ends = np.flatnonzero(inside & free[:-1]) + 1
    rows = np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(starts, at)))
    return starts, ends, rows
