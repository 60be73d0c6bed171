"""Words of many texts at once: numpy over the UTF-8 buffers of Arrow string columns.

A batch is cut into runs of whole documents of about ``RUN`` bytes, so temporary arrays stay small whatever the
batch size; one document longer than that is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN = 1 << 20
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h ^= h >> _U(shift)
            h *= _U(factor)
        h ^= h >> _U(33)
    return h


def _classes(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: Words [^\x20\x09-\x0D]+ : everything but ASCII white space.
SPACED = _classes(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text in lower case: digits, ASCII letters and all beyond ASCII.
ALNUM = _classes(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOWER_CODES = _CODES[LOWER]
_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = []


def _grown(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, RUN) + 1
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers.append(np.multiply.accumulate(p))
    return _powers


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(data: np.ndarray, offsets: np.ndarray, size: int = RUN) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last + 1, bytes, offsets) of runs of whole documents."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the number of words before it (one more at the end)."""
    m = inside[data]
    before, after = np.zeros(len(m), bool), np.zeros(len(m), bool)
    before[1:], after[:-1] = m[:-1], m[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(m)]] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; A-Z count as a-z if ``lower``."""
    up, down = _grown(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER_CODES if lower else _CODES)[data] * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of n consecutive words from each position; the caller leaves out windows that cross documents."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(m, np.uint64), 1
    with np.errstate(over="ignore"):
        for k in range(n):
            out += hashes[k : k + m] * _U(factor)
            factor = factor * 0x9FB21C651E98DF25 % (1 << 64)
    return mix(out)


def window_docs(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows of n words that lie within a document, and the document of each."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][docs], docs
