"""Vectorised text primitives on Arrow string buffers.

Executors see a batch of texts as one UTF-8 byte buffer with offsets.  Every
helper works on slices of that buffer, so a batch of many short texts costs a
few numpy passes and a very long text is cut at word boundaries instead of
being held several times over in wide arrays.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled by one numpy pass; temporaries take about 60 times this.
SLICE_BYTES = 1 << 20

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(lower: bool, keep: np.ndarray) -> np.ndarray:
    """A pseudo-random 64-bit value per byte; A-Z share the value of a-z if lower."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        table[65:91] = table[97:123]
    table[~keep] = 0
    return table


def byte_set(chars: bytes = b"", *, high: bool = False) -> np.ndarray:
    """Membership table of bytes; high adds every byte of a multi-byte code point."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    if high:
        table[128:] = True
    return table


#: White space of the word pattern: blank, tab, newline, VT, FF, carriage return.
BLANKS = byte_set(b" \t\n\x0b\x0c\r")
#: ASCII letters and digits, and all bytes of longer code points.
ALNUM = byte_set(
    b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", high=True
)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if raw[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Give freed memory of this Python process back to the system, where the C library can.

    Spark keeps idle workers, whose freed memory would count beside the work of others.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `size` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def _power_arrays(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, _PRIME, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def _window(
    buf: np.ndarray, first: np.ndarray, inside: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of one window; first marks bytes at which a text begins."""
    n = len(buf)
    within = inside[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = within[:-1]
    starts = np.flatnonzero(within & (~before | first))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~within[1:] | first[1:]
    ends = np.flatnonzero(within & after) + 1
    up, down = _power_arrays(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[buf] * up, out=sums[1:])
    return starts, ends, mix64((sums[ends] - sums[starts]) * down[starts])


def words(
    buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every maximal run of `inside` bytes.

    No run crosses from one text to the next.  Windows of a buffer above the
    slice size are cut before a byte outside `inside`, so no run is cut.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    found, at = [], 0
    while at < n:
        to = min(n, at + SLICE_BYTES)
        if to < n:
            cuts = np.flatnonzero(~inside[buf[at + 1 : to]])
            if len(cuts):
                to = at + 1 + int(cuts[-1])
            else:
                while to < n and inside[buf[to]]:
                    to += 1
        s, e, h = _window(buf[at:to], first[at:to], inside, table)
        found.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def row_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each row, and the number of words at the end."""
    return np.searchsorted(starts, offsets, "left")


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for every row, 0 for an empty one."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
