"""Texts of an Arrow batch as numpy arrays: words, their hashes, and windows.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. All functions work
on the bytes of a whole batch at once; documents are slices given by offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240101))
#: One random value per byte, and an odd multiplier: a word's hash sums them by position.
_BYTE = _rng.integers(0, 2**64, 256, dtype=U64)
_STEP = U64(0x9E3779B97F4A7C15)
#: Bytes hashed at once; bounds the 8-byte temporaries of a batch.
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text; a longer row stands alone."""
    if not batch.num_rows:
        return
    _, off = flat(batch.column(text))
    cut, start = 0, 0
    for i in range(1, batch.num_rows + 1):
        if off[i] - start > limit and i - 1 > cut:
            yield batch.slice(cut, i - 1 - cut)
            cut, start = i - 1, off[i - 1]
    yield batch.slice(cut)


def words(data: np.ndarray, off: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets by document) of the runs of bytes that are not ``blank``;
    words never cross documents."""
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    begins[heads] |= inside[heads]
    ends = inside
    ends = ends.copy()
    ends[:-1] &= ~inside[1:]
    tails = off[1:][off[:-1] < off[1:]] - 1
    ends[tails] |= inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per slice of ``data``, equal for equal bytes."""
    out = np.empty(len(starts), U64)
    lens = ends - starts
    for i in np.flatnonzero(lens > _CHUNK):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    short = np.flatnonzero(lens <= _CHUNK)
    if not len(short):
        return out
    starts, lens = starts[short], lens[short]
    value = np.empty(len(starts), U64)
    powers = np.multiply.accumulate(np.full(max(1, int(lens.max())), _STEP))
    total = np.cumsum(lens)
    cut = 0
    while cut < len(starts):
        done = total[cut - 1] if cut else 0
        to = max(cut + 1, int(np.searchsorted(total, done + _CHUNK, "right")))
        n = lens[cut:to]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        byte = _BYTE[data[place + np.repeat(starts[cut:to], n)]]
        byte *= powers[place]
        filled = n > 0
        value[cut:to] = n.astype(U64)
        if filled.any():
            value[cut:to][filled] += np.add.reduceat(byte, first[filled])
        cut = to
    out[short] = mix(value)
    return out


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k neighbouring words; entry i starts at word i."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = mix(out * _STEP + hashes[j : j + n])
    return out


def docs_of(offsets: np.ndarray) -> np.ndarray:
    """The document of each item, for items given by offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def repeated(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group starts) of the items sorted by document and key."""
    order = np.lexsort((keys, docs))
    k, d = keys[order], docs[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return order, np.flatnonzero(new)
