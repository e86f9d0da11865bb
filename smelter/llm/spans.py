"""Vectorised work on the bytes of many texts at once (numpy, inside tasks).

A column of texts is taken in slices of about ``SLICE_BYTES`` so that memory
does not depend on the batch; a slice holds whole texts, one after another,
in one byte array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

BREAK = np.zeros(256, bool)
BREAK[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; offsets start at 0 and have
    one entry more than rows.  The column is binary or string without nulls."""
    values = batch.column(column)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if len(values) == 0:
        return
    wide = pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8) if values.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(values):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value of each 64-bit value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = max(n, 2 * SLICE_BYTES)
        steps = np.full(size, _INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 4 * SLICE_BYTES:
            _powers[inverse] = have
    return have[:n]


class RangeHash:
    """64-bit hashes of byte ranges, from one running sum: equal bytes give
    equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, table: np.ndarray = _BYTE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * powers(len(data)), out=self.sums[1:])

    def raw(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(self.sums):
            return np.zeros(0, np.uint64)
        return (self.sums[end] - self.sums[begin]) * powers(len(self.sums), True)[begin]

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed(self.raw(begin, end) + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def second_table() -> np.ndarray:
    """Another byte table, for a second hash independent of the first."""
    return np.random.default_rng(77003).integers(1, 1 << 63, 256, dtype=np.uint64)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values; no run crosses a text's end."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    seams = offsets[1:-1]
    seams = seams[(seams > 0) & (seams < len(inside))]
    begin[seams] |= inside[seams]
    end[seams - 1] |= inside[seams - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return runs(~BREAK[data], offsets)


def owner(begins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each position belongs to (empty rows own none)."""
    return np.searchsorted(offsets, begins, "right") - 1


def per_row(rows: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(rows, weights=weights, minlength=n)[:n]


def first_of(rows: np.ndarray, n: int) -> np.ndarray:
    """For sorted ``rows``: where each row's entries begin, and the total."""
    return np.searchsorted(rows, np.arange(n + 1))
