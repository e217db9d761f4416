"""Vectorised tokenising and hashing of UTF-8 columns with numpy.

Texts stay one byte buffer with offsets, as Arrow holds them. Hashes of any byte range come from
prefix sums of ``T[byte] * B**position`` modulo 2**64, so a word costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_B = 0x9E3779B97F4A7C15 | 5
_BINV = pow(_B, -1, 1 << 64)
_SPACE = bytes([0x20, *range(0x09, 0x0E)])

#: Words of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
NOT_SPACE = np.array([b not in _SPACE for b in range(256)])
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_T = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _Powers:
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES + 1)
            with np.errstate(over="ignore"):
                for name, base in (("up", _B), ("down", _BINV)):
                    p = np.full(size, base, dtype=np.uint64)
                    p[0] = 1
                    setattr(cls, name, np.multiply.accumulate(p))
        return cls.up, cls.down


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, offsets - offsets[0]


def slices(buf: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole rows of about ``most`` bytes."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(buf: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``members`` bytes in each row, and each row's first run."""
    inside = members[buf]
    n = len(buf)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges."""
    sums, down = prefix_sums(buf)
    return ranged(sums, down, starts, ends)


def prefix_sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _Powers.get(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_T[buf] * up[: len(buf)], out=sums[1:])
    return sums, down


def ranged(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return splitmix((sums[ends] - sums[starts]) * down[starts])


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours; the result is shorter by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = hashes[:n] + np.uint64(k)
    for j in range(1, k):
        acc = acc * np.uint64(0xD1342543DE82EF95) + hashes[j : j + n]
    return splitmix(acc)


def code_points(buf: np.ndarray) -> np.ndarray:
    """Running count of code points before each byte, with the total at the end."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out
