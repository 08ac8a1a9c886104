"""Whole-text primitives on Arrow string buffers, vectorised with numpy.

Texts are handled as UTF-8 bytes. A word is a maximal run of bytes outside
\\x20 and \\x09-\\x0D; no byte of a multi-byte character is one of these, so
words on bytes and on characters are the same. Hashes take eight bytes (or one word) at a
time through a bijective non-linear mix, so no structure of a text cancels out, and long words
through BLAKE2; they are keyed by a seed and the same on every machine. Two seeds
give 128 bits where equality decides what is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Delimiters for plain words: everything but ASCII letters, digits and the bytes of other characters.
PLAIN = np.ones(256, bool)
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = PLAIN[128:] = False
CHUNK = 1 << 19

#: A word of more bytes is hashed by BLAKE2.
LONG_WORD = 64
_ODD, _LENGTH, _SEED = U64(0x9E3779B97F4A7C15), U64(0xA24BAED4963EE407), U64(0xC2B2AE3D27D4EB4F)
_LOW_BYTES = np.asarray([(1 << 8 * n) - 1 for n in range(9)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finishing mix of 64-bit values."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(32))


def _times(n: int, by: np.uint64) -> np.uint64:
    return U64(int(n) * int(by) & 0xFFFFFFFFFFFFFFFF)


def range_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the bytes buf[start:end] for each pair; depends on the content and the seed alone."""
    if not len(start):
        return np.zeros(0, U64)
    eight = np.ndarray((len(buf) + 1,), "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))
    n = end - start
    h = mix(n.astype(U64) * _LENGTH + _times(seed, _SEED))
    h = mix(h ^ (eight[start] & _LOW_BYTES[np.minimum(n, 8)]))
    live, at = np.flatnonzero(n > 8), 8
    while len(live) and at < LONG_WORD:
        h[live] = mix(h[live] * _ODD ^ (eight[start[live] + at] & _LOW_BYTES[np.minimum(n[live] - at, 8)]))
        at += 8
        live = live[n[live] > at]
    for i in live.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
    return h


def windows(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of h[i:i+k] for every i with i+k <= len(h), from spans of doubling width."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    span, width, at, out = mix(h ^ _times(seed, _SEED)), 1, 0, None
    while True:
        if k & width:
            out = span[at : at + n] if out is None else mix(out * _ODD + span[at : at + n])
            at += width
        if 2 * width > k:
            return mix(out + _times(k, _LENGTH))
        span = mix(span[:-width] * _ODD + span[width:])
        width *= 2


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values, by sorting (np.unique hashes, which is slower and takes more memory)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def slices(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of rows) in pieces of about limit bytes; a longer text is a piece of its own. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, to, buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def pieces(buf: np.ndarray, delimiters: np.ndarray, size: int = CHUNK) -> Iterator[np.ndarray]:
    """A text's bytes in pieces of about size bytes that end before a delimiter, so that no word is cut; a longer word is in one piece."""
    at = 0
    while len(buf) - at > 2 * size:
        to = at + size
        while to < len(buf) and not (gaps := np.flatnonzero(delimiters[buf[to : to + 4096]])).size:
            to += 4096
        to = min(to + int(gaps[0]) if to < len(buf) else to, len(buf))
        yield buf[at:to]
        at = to
    yield buf[at:]


def words(buf: np.ndarray, offs: np.ndarray, delimiters: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more at the end)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    ink = ~delimiters[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.zeros(len(buf), bool)
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    after = np.zeros(len(buf), bool)
    after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def owners(ptr: np.ndarray) -> np.ndarray:
    """The row of each item, from the row pointers."""
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def bag(rows: np.ndarray, buckets: np.ndarray, n_rows: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each row: row pointers, buckets, counts."""
    key = np.sort((rows.astype(U64) << U64(bits)) | buckets.astype(U64))
    if not len(key):
        return np.zeros(n_rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    counts = np.diff(np.r_[first, len(key)])
    key = key[first]
    ptr = np.searchsorted(key >> U64(bits), np.arange(n_rows + 1).astype(U64))
    return ptr, (key & U64((1 << bits) - 1)).astype(np.int64), counts


def segment_sum(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of values[ptr[i]:ptr[i+1]]; 0 where empty. values: 1-d or 2-d."""
    out = np.zeros((len(ptr) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(ptr[1:] > ptr[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, ptr[:-1][full], axis=0)
    return out


def schema(kept: DataFrame, more: str, skip: int = 0) -> StructType:
    """kept's fields from the skip-th on, whatever their names, and those of a DDL string."""
    return StructType([*kept.schema.fields[skip:], *StructType.fromDDL(more).fields])
