"""Vectorised text primitives over the UTF-8 bytes of Arrow string columns.

A column is cut into slices of a few megabytes.  Within a slice, words, word
hashes and byte n-grams of all its rows are found with a handful of numpy
calls, so the cost is a few nanoseconds a byte and memory stays bounded by the
slice (or by the one text that is longer than it).  All hashes are fixed
functions of the bytes: every executor and every retry computes the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Separators for word n-grams: every ASCII byte that is no letter or digit.
NON_WORD = np.ones(256, dtype=bool)
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = False
NON_WORD[128:] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        ups = np.full(size, _BASE, dtype=np.uint64)
        downs = np.full(size, inverse, dtype=np.uint64)
        ups[0] = downs[0] = 1
        _powers[:] = [np.multiply.accumulate(ups), np.multiply.accumulate(downs)]
    return _powers[0], _powers[1]


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) of consecutive rows; null reads as empty.

    ``offsets`` has one entry more than the slice has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, first + rows, max(first + 1, last))
        yield first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """The words of a slice: lower-cased bytes, word bounds, words by row."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.bytes = LOWER[raw]
        gap = separators[raw]
        before = np.empty(len(raw) + 1, dtype=bool)
        before[0] = before[-1] = True
        before[1:-1] = gap[:-1]
        after = np.empty(len(raw) + 1, dtype=bool)
        after[:-1] = gap
        after[-1] = True
        edge = offsets[(offsets > 0) & (offsets < len(raw))]
        starts = before[:-1] & ~gap
        starts[edge] |= ~gap[edge]
        ends = ~gap & after[1:]
        ends[edge - 1] |= ~gap[edge - 1]
        self.gap = gap
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        #: Words of row i are those from row_at[i] to row_at[i + 1].
        self.row_at = np.searchsorted(self.starts, offsets)

    def _prefix(self) -> tuple[np.ndarray, np.ndarray]:
        ups, downs = _power_tables(len(self.bytes) + 1)
        total = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * ups[: len(self.bytes)], out=total[1:])
        return total, downs

    def hashes(self, *prefixes: int) -> list[np.ndarray]:
        """64-bit hashes of the words, then of their first k bytes for each k
        (a shorter word stands for itself)."""
        total, downs = self._prefix()
        base = downs[self.starts]
        size = self.ends - self.starts
        out = []
        for k in (0, *prefixes):
            cut = np.minimum(size, k) if k else size
            out.append(mix((total[self.starts + cut] - total[self.starts]) * base + np.uint64(0x632BE59BD9B4E019) * cut.astype(np.uint64)))
        return out

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words as bytes with one space after each, and their new bounds."""
        size = self.ends - self.starts
        new_starts = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size + 1, out=new_starts[1:])
        out = np.full(int(new_starts[-1]), 32, dtype=np.uint8)
        kept = np.ones(len(out), dtype=bool)
        kept[new_starts[1:] - 1] = False
        out[kept] = self.bytes[~self.gap]
        return out.tobytes(), new_starts[:-1], new_starts[:-1] + size


def spread(row_at: np.ndarray) -> np.ndarray:
    """Row number of every word, from where each row's words begin."""
    return np.repeat(np.arange(len(row_at) - 1), np.diff(row_at))
