"""Numpy helpers on the UTF-8 bytes of a batch of texts.

Every function works on whole texts.  A batch is cut into pieces of a bounded
number of bytes (one text is never cut), so a task's memory follows the piece
size and its longest text.  Hashes are Rabin-Karp polynomials modulo 2**64
over randomised symbols, so the hash of any span is one difference of prefix
sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time inside a task.
PIECE_BYTES = 1_000_000

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (spreads every bit over all others)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class SpanHash:
    """Rabin-Karp hash of spans, modulo 2**64, for one odd base."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            size = max(n, 1 << 16)
            for name, base in (("_pow", self.base), ("_inv", self.inverse)):
                p = np.full(size, base & ((1 << 64) - 1), np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self._pow[:n], self._inv[:n]

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[s:e] for each pair of starts and ends (equal spans, equal hashes)."""
        pw, inv = self._powers(len(values) + 1)
        prefix = np.empty(len(values) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(values * pw[: len(values)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * inv[starts]


WORD_HASH = SpanHash(11)


def fill_text(column: pa.Array) -> pa.Array:
    """Null texts as empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without nulls; offsets has len + 1 entries from 0."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    raw, off = buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, raw[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def words_of(raw: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of maximal runs of non-separator bytes that never cross a text's edge."""
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separator[raw]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    head[edge] = inside[edge]
    tail[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(head)
    ends = np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def space_table() -> np.ndarray:
    """True for the bytes x20 and x09 to x0D."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


SPACE = space_table()


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    h = WORD_HASH.spans(WORD_HASH.table[raw], starts, ends)
    return mix64(h + (ends - starts).astype(np.uint64))
