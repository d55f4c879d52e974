"""Vectorised words of Arrow text columns: byte positions and 64-bit hashes, no per-word Python.

A word is a run of bytes other than 0x20 and 0x09-0x0D; those are ASCII, so splitting the UTF-8 bytes
splits the text. Hashes are polynomials modulo 2^64 over random byte values, taken from prefix
sums and then mixed, so any substring's hash costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # text handled at once; a longer document makes a slice of its own
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses, modulo 2^64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 65_536)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _POWERS[key] = np.cumprod(run, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes; nulls count as empty.

    Yields (first row, end row, bytes, offsets of the rows in them).
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(buf: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (and the total).

    ``apart`` says which bytes part words.
    """
    inside = ~apart[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    up, _ = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[buf] * up[: len(buf)], out=sums[1:])
    return sums


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they stand."""
    sums = prefix_sums(buf)
    _, down = powers(len(buf) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_bytes(items: list[bytes]) -> np.ndarray:
    """The same hashes for a list of byte strings."""
    buf = np.frombuffer(b"".join(items), np.uint8)
    ends = np.cumsum([len(x) for x in items]) if items else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if items else np.zeros(0, np.int64)
    return hash_spans(buf, starts, ends.astype(np.int64))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    out = buf.copy()
    out[(buf >= 65) & (buf <= 90)] += 32
    return out
