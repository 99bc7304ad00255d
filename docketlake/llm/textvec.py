"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Separators are ASCII bytes, which never occur inside a longer UTF-8 sequence, so words are found on bytes. Hashes are
polynomials modulo 2**64 over a random table of byte values, finalised by a mixer; equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is handled whole.
CHUNK_BYTES = 2 << 20

BREAK = np.zeros(256, bool)
BREAK[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: list[np.ndarray] = []
_values: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n + 1 of each; one pair serves all seeds."""
    if not _powers or len(_powers[0]) <= n:
        size, base = max(n, CHUNK_BYTES) + 1, 0x9E3779B97F4A7C15
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = base, pow(base, -1, 1 << 64)
        _powers[:] = np.multiply.accumulate(steps, axis=1)
    return _powers


def _value(seed: int) -> np.ndarray:
    """A random number for each byte."""
    if seed not in _values:
        _values[seed] = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed)) | np.uint64(1)
    return _values[seed]


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs values[start:end], whatever their place. Values are random numbers that depend on a seed."""
    power, inverse = _power(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def joint_hash(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of runs of hashes: those of words to those of windows. Other seeds hash independently."""
    return run_hash(mix(hashes ^ np.uint64(0xD1B54A32D192ED03 * (2 * seed + 1) % (1 << 64))), starts, ends)


@dataclass
class Chunk:
    """Rows ``lo`` to ``hi`` of a column: their bytes and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def runs(self, breaks: np.ndarray = BREAK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row (from 0) of each maximal run of bytes that do not break, in order."""
        inside = ~breaks[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = self.offsets[:-1] < self.offsets[1:]
        at, to = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        first[at], last[to] = inside[at], inside[to]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 1, lower: bool = False) -> np.ndarray:
        """Hashes of runs that lie in order, some megabytes at a time, so that a long text needs little more than itself."""
        table, out, lo = _value(seed), np.empty(len(starts), np.uint64), 0
        table = table[LOWER] if lower else table
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK_BYTES, side="right")))
            first = starts[lo]
            out[lo:hi] = run_hash(table[self.data[first : ends[hi - 1]]], starts[lo:hi] - first, ends[lo:hi] - first)
            lo = hi
        return out

    def total(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each row the mask (a table of 256) marks."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(mask[self.data], out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def windows(hashes: np.ndarray, rows: np.ndarray, size: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of each window of ``size`` consecutive words of one row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return at, joint_hash(hashes, at, at + size, seed)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), at


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a text column, some megabytes at a time."""
    data, at = column_bytes(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield Chunk(lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


def distinct_by_row(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row: distinct hashes, and how many items have a hash that the row holds twice or more."""
    _, first, times = np.unique(mix(hashes ^ mix(rows.astype(np.uint64))), return_index=True, return_counts=True)
    return np.bincount(rows[first], minlength=n), np.bincount(rows[first], np.where(times > 1, times, 0), n).astype(np.int64)
