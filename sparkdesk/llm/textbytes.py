"""Text columns as flat arrays, for functions that run inside Arrow tasks.

Every helper works on one slice of a column at a time, so memory follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that near values become far ones (one to one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece hold about ``limit`` bytes (a longer text stands alone)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a text column; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that don't cross a row, and each row's first run (one more than rows)."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of 64-bit values, from running sums, so that the cost is that of one pass."""
    size = max(len(values), SLICE_BYTES)
    up, down = _powers(1 << (size - 1).bit_length())
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run of bytes."""
    return span_hashes(_BYTE_VALUES[data], starts, ends)


def spaced_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between white space (space and the bytes 9 to 13), A-Z lower-cased, and each row's first word."""
    offsets, data = flat(column)
    data = lower_ascii(data)
    starts, ends, first = runs((data != 32) & ((data < 9) | (data > 13)), offsets)
    return run_hashes(data, starts, ends), first


def letter_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters in lower case (every character beyond ASCII counts as one), and each row's first run."""
    offsets, data = flat(pc.utf8_lower(column.fill_null("")))
    starts, ends, first = runs(((data >= 97) & (data <= 122)) | (data >= 128), offsets)
    return run_hashes(data, starts, ends), first


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values; fewer values give no window."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        out *= _BASE
        out += hashes[j : j + n]
    return mix(out)
