"""Whole-batch text primitives on the bytes of Arrow columns.

A text column is taken as one byte array with row offsets; tokens are spans of
it, found and hashed with numpy for all rows of a chunk at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; one longer row is a chunk of its own.
CHUNK_BYTES = 1 << 19
#: Rows worked on at once: their numbers fit 16 bits.
CHUNK_ROWS = 1 << 15

U64 = np.uint64
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = np.asarray(x, U64)
    y = x >> U64(30)
    y ^= x
    y *= U64(0xBF58476D1CE4E5B9)
    y ^= y >> U64(27)
    y *= U64(0x94D049BB133111EB)
    y ^= y >> U64(31)
    return y


def lowered_values(lower: bool) -> np.ndarray:
    """One random 64-bit value per byte; A-Z share those of a-z if ``lower``."""
    byte = np.arange(256, dtype=U64)
    if lower:
        byte[65:91] += U64(32)
    return mix64(byte + U64(0x1F83D9ABFB41BD6B))


EXACT_BYTES = lowered_values(False)
LOWER_BYTES = lowered_values(True)

#: Words of the shingle, window and signature operators: letters, digits and all of non-ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
#: Tokens between ASCII white space.
SOLID_BYTES = np.ones(256, bool)
SOLID_BYTES[[9, 10, 11, 12, 13, 32]] = False

_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=U64)
    return _POWERS[0], _POWERS[1]


class Hasher:
    """Hashes of any spans of one array of bytes, or of the 64-bit hashes of larger symbols, from its prefix sums."""

    def __init__(self, data: np.ndarray, values: np.ndarray = EXACT_BYTES):
        n = len(data)
        power, self.inverse = _powers(n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((values[data] if data.dtype == np.uint8 else data) * power[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.sums[ends] - self.sums[starts]
        h *= self.inverse[starts]
        h += np.asarray(ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
        return mix64(h)

    def every(self, width: int) -> np.ndarray:
        """Hashes of the spans of ``width`` from every start on."""
        n = len(self.sums) - width
        h = self.sums[width:] - self.sums[:n]
        h *= self.inverse[:n]
        h += U64(width * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        return mix64(h)


def column_bytes(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Data and row offsets of a text column; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] if where else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(batch: pa.RecordBatch, name: str, limit: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole rows."""
    data, offsets = column_bytes(batch, name)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + (limit or CHUNK_BYTES), "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + CHUNK_ROWS)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    if _TRIM is not None:  # free memory goes back: a worker is reused, with what it holds, by later stages
        _TRIM(0)


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of member bytes, never across rows, and
    the index of each row's first span (one more entry than rows)."""
    inside = member[data]
    joined = inside[1:] & inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    joined[edge - 1] = False
    first, last = inside.copy(), inside
    first[1:] &= ~joined
    last = inside.copy()
    last[:-1] &= ~joined
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each span, from the indices of each row's first."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first span and hash of each run of ``width`` spans within a row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = np.zeros(n, U64)
    for k in range(width):
        h = h * U64(_BASE) + hashes[k : k + n]
    row = rows_of(first)
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    return at, mix64(h[at] + U64(width))


_LET_GO: dict[str, Callable[[], object]] = {}


def only(name: str = "", let_go: Callable[[], object] | None = None) -> None:
    """From now on a Python worker holds the large tables of ``name`` alone: those
    of operators that it has worked for before are let go."""
    for other in [k for k in _LET_GO if k != name]:
        _LET_GO.pop(other)()
    if let_go is not None:
        _LET_GO[name] = let_go


def take_columns(batch: pa.RecordBatch, names: list[str], lo: int, hi: int) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(x)).slice(lo, hi - lo) for x in names]
