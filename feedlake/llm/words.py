"""Vectorised word splitting and hashing of Arrow text columns.

All helpers work on the UTF-8 bytes of a run of texts at once.  Word
separators of every operator are ASCII bytes, so splitting bytes equals
splitting code points.  A null text has no bytes and hence no words.
Word and window identities are 64-bit hashes of the whole byte string.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
U64 = np.uint64


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Complement of ``[^\x20\x09-\x0D]``.
SPACE = _byte_set((0x20, 0x20), (0x09, 0x0D))
#: Complement of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` on lower-cased text.
NON_ALNUM = _byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public fmix64 constants)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(max(n, 1), dtype=U64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U64(pow(_BASE, done, 1 << 64))
        done += step
    return out


class Flat(NamedTuple):
    data: np.ndarray      # uint8, all texts joined
    offsets: np.ndarray   # int64, len(texts) + 1


class Words(NamedTuple):
    start: np.ndarray     # byte offset in Flat.data
    end: np.ndarray
    first: np.ndarray     # per text, index of its first word (len(texts) + 1)
    hash: np.ndarray      # uint64

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def flat(column: pa.Array) -> Flat:
    """Bytes and offsets of a text column; nulls become empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0 or buffers[2] is None:
        return Flat(np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return Flat(data, offsets - offsets[0])


_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the system; workers live as long as the application."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most ``limit`` text bytes each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, n = 0, len(sizes)
    total = np.cumsum(sizes)
    while at < n:
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
    give_back()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span (spans are disjoint, in order, not empty).

    ``inside``: mask of the bytes within spans, when the caller has it.
    """
    if len(start) == 0:
        return np.empty(0, U64)
    lens = end - start
    at = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=at[1:])
    total = int(at[-1] + lens[-1])
    if inside is None:
        index = np.arange(total) + np.repeat(start - at, lens)
        span_bytes = data[index]
    else:
        span_bytes = data[inside]
    place = np.arange(total, dtype=np.int32 if total < 1 << 31 else np.int64)
    place -= np.repeat(at.astype(place.dtype), lens)
    terms = _VALUE[span_bytes]
    terms *= _powers(int(lens.max()))[place]
    return mix(np.add.reduceat(terms, at) + lens.astype(U64))


def split(texts: Flat, separators: np.ndarray, hashed: bool = True) -> Words:
    """Maximal runs of non-separator bytes, never across two texts."""
    data, offsets = texts
    n = len(data)
    if n == 0:
        empty = np.empty(0, np.int64)
        return Words(empty, empty, np.zeros(len(offsets), np.int64), np.empty(0, U64))
    inside = ~separators[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets, side="left")
    return Words(start, end, first, hash_spans(data, start, end, inside) if hashed else np.empty(0, U64))


_STEP = mix(np.arange(1001, 1033, dtype=U64)) | U64(1)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every run of ``size`` words within one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    h = words.hash[:n] * _STEP[0]
    for j in range(1, size):
        h += words.hash[j:n + j] * _STEP[j]
    text = words.text
    whole = np.flatnonzero(text[:n] == text[size - 1:])
    return mix(h[whole]), whole


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points that start before each byte (len(data) + 1)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
