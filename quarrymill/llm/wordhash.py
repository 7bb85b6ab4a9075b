"""Words and shingles of a batch of texts as 64-bit hashes, computed over whole byte buffers with numpy.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, with A-Z lower-cased. Equal words have equal hashes; different
words collide with a probability of about 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240611)
LOWER = np.arange(256, dtype="u1")
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACES = _RNG.integers(1, 1 << 63, 8, dtype="u8") * np.uint64(2) + np.uint64(1)
#: Stands for the end of a text among word hashes.
END = np.uint64(0x1D8E4E27C47D124F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, "i8" if wide else "i4", n + 1 + column.offset)[column.offset :].astype("i8")
    data = np.frombuffer(data, "u1") if data is not None and data.size else np.zeros(0, "u1")
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20, most: int = 60_000):
    """(first, last) rows of runs of whole texts of about ``limit`` bytes, and one row at least."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n, first + most)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word in order."""
    if not len(data):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    low = LOWER[data]
    inside = ~IS_SPACE[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    heads = np.searchsorted(at, starts)
    lengths = np.diff(np.r_[heads, len(at)])
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, "u8"))
    value = BYTE_CODES[low[at]]
    value *= powers[place]
    total = np.add.reduceat(value, heads)
    row = np.searchsorted(offsets, starts, "right") - 1
    return mix(total ^ lengths.astype("u8")), row


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of ``size`` words of each row, ordered by row and hash. A row with fewer words
    has one shingle of them all; a row without words has none."""
    h, row = words(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(row, minlength=n)
    if not len(h):
        return h, row
    m = len(h)
    first = np.cumsum(counts) - counts
    left = np.repeat(first + counts, counts) - np.arange(m)  # words of the row from here on
    code = np.zeros(m, "u8")
    for k in range(size):
        part = np.zeros(m, "u8")
        if k < m:
            part[: m - k] = h[k:] * PLACES[k]
        code += np.where(left > k, part, np.uint64(0))
    keep = left >= size
    short = first[(counts > 0) & (counts < size)]
    keep[short] = True
    code[short] ^= counts[row[short]].astype("u8")
    s, row = mix(code[keep]), row[keep]
    order = np.argsort(s)
    order = order[np.argsort(row[order].astype("u2" if n < 65536 else "i8"), kind="stable")]
    s, row = s[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    return s[new], row[new]
