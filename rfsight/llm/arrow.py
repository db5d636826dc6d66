"""Views of Arrow text columns as byte arrays, and hashes over them, for use inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd, hence invertible modulo 2**64: a hash of any slice comes from two prefix sums.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def give_back() -> None:
    """Return freed memory to the system; a Python worker outlives its task and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most`` bytes of text, or of one row."""
    for batch in batches:
        ends = utf8(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
        give_back()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i is bytes[offsets[i]:offsets[i + 1]]; a null is empty."""
    binary = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64, count=len(binary) + binary.offset + 1)
    offsets = offsets[binary.offset :]
    data = binary.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Random 64-bit value of each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class Powers:
    """Powers of BASE and of its inverse, grown as needed and kept by the task."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[t] * BASE**t for i <= t < j (modulo 2**64)."""
    up, _ = POWERS.upto(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each slice by content alone."""
    _, down = POWERS.upto(len(sums))
    return mix((sums[stops] - sums[starts]) * down[starts])


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, stops, word offsets per row) of maximal runs of word bytes that do not cross rows."""
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[row_starts] = inside[row_starts]
    last[row_starts[1:] - 1] = inside[row_starts[1:] - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
