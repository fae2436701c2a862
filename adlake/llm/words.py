"""Words, word hashes and shingles of whole texts, in numpy over Arrow batches.

A word is a longest run of bytes other than space and \\x09-\\x0D; A-Z are lower-cased.
Hashes are 64 bits of the word's bytes alone, so equal words agree in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # texts handled at a time; a longer text is one chunk
BLOCK_BYTES = 1 << 20  # bytes hashed at a time, cut between words
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(_BASE))
_VALUE_LOWER = _VALUE[_LOWER]
_ORDER = mix(np.arange(1, 65, dtype=np.uint64) * _U(_BASE)) | _U(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0], _POWERS[1]


@dataclass
class Words:
    """Words of some texts: text i has words ptr[i]..ptr[i+1]."""

    ptr: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def _hash_block(data, starts, ends, value) -> np.ndarray:
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    low, high = int(starts[0]), int(ends[-1])
    up, down = _powers(high - low + 1)
    sums = np.zeros(high - low + 1, dtype=np.uint64)
    np.cumsum(value[data[low:high]] * up[:high - low], out=sums[1:])
    s, e = starts - low, ends - low
    return mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hashes of the runs data[starts:ends], BLOCK_BYTES at a time."""
    n = len(data)
    if n <= BLOCK_BYTES:
        return _hash_block(data, starts, ends, value)
    at = np.unique(np.searchsorted(starts, np.arange(0, n + BLOCK_BYTES, BLOCK_BYTES)))
    parts = [_hash_block(data, starts[a:b], ends[a:b], value) for a, b in zip(at[:-1], at[1:], strict=True)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words of the texts data[offsets[i]:offsets[i+1]] (UTF-8 bytes)."""
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[:n])
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first = inside[:n] & (cut[:n] | ~np.concatenate(([False], inside[:max(n - 1, 0)]))[:n])
    last = inside[:n] & (cut[1:] | ~inside[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    value = _VALUE_LOWER if lower else _VALUE
    return Words(np.searchsorted(starts, offsets), hash_runs(data, starts, ends, value), starts, ends, data)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def give_back() -> None:
    """Return the memory that Arrow keeps of a worker's earlier tasks: workers serve many steps,
    and what each of them has freed would count for all that follow."""
    pa.default_memory_pool().release_unused()


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of about CHUNK_BYTES of text at a time, with their bytes and offsets."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = text_buffers(batch.column(column))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK_BYTES, "right")) - 1)
            yield batch.slice(row, stop - row), data[at[row]:at[stop]], at[row:stop + 1] - at[row]
            row = stop


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words, and where each text's begin.

    A shorter text that has words is one run of all of them.
    """
    h, ptr = words.hashes, words.ptr
    counts = np.diff(ptr)
    n = len(h)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        if n > j:
            out[:n - j] += h[j:] * _ORDER[j]
    keep = np.ones(n, dtype=bool)
    tail = ptr[1:, None] - 1 - np.arange(width - 1)[None, :]
    keep[tail[tail >= ptr[:-1, None]]] = False
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        a, b = ptr[i], ptr[i + 1]
        out[a] = (h[a:b] * _ORDER[:b - a]).sum(dtype=np.uint64) + _U(b - a)
        keep[a] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return mix(out[keep]), kept[ptr]


def distinct(values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted set of values of each text, and where each begins; ``values`` is sorted in place."""
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[ptr[:-1][ptr[:-1] < len(values)]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[ptr]
