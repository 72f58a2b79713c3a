"""Vectorized text work on Arrow batches: words, hashes and shingles with numpy.

A batch's texts are one byte buffer with document offsets. Word boundaries,
word hashes and shingle hashes come from whole-buffer numpy operations, so no
Python code runs per word. Hashes are 64-bit; a word's hash is a polynomial of
its bytes (modulo 2**64, odd base) with a final bit mix.

Nulls count as empty texts. Batches are cut into slices of at most
``SLICE_BYTES`` (a longer single text is one slice), so memory follows the
slice and not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

#: Bytes of a word as `[^\x20\x09-\x0D]+` sees them.
NON_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: Bytes of a word as `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` sees them after A-Z are lower-cased.
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX2
    return x ^ (x >> np.uint64(33))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` odd 64-bit constants that depend on ``salt`` only."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(salt)) | np.uint64(1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0..n (kept per worker for slice-sized n)."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = n + 1
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if n > 4 * SLICE_BYTES:
            return up, down
        _powers["up"], _powers["down"] = up, down
    return _powers["up"], _powers["down"]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, o - o[0]


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: its allocator returns memory by itself or not at all
    _libc = None


def trim() -> None:
    """Give freed memory back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str | int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in row slices of at most ``limit`` text bytes (one row at least)."""
    limit = limit or SLICE_BYTES
    if batch.num_rows == 0:
        return
    _, offs = buffer_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    trim()


@dataclass
class Words:
    """Words of a slice: byte bounds, hash, and each document's range of words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # first[d]:first[d + 1] are the words of document d

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of maximal word runs; a document's end always ends a word."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(before & (~inside | cut))
    return start, end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    n = len(data)
    up, down = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix64((total[end] - total[start]) * down[start])


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    start, end = word_bounds(data, offsets, is_word)
    first = np.searchsorted(start, offsets)
    return Words(start, end, span_hashes(data, start, end), first)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (len - k + 1 of them, over document ends too)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(k * int(_MIX1) % (1 << 64)))
    for j, c in enumerate(seeds(k, 17)):
        total += hashes[j: j + n] * c
    return mix64(total)


def shingle_sets(words: Words, k: int = 5) -> list[np.ndarray]:
    """Each document's sorted distinct shingle hashes; fewer than ``k`` words are one shingle, none are an empty set."""
    grams = gram_hashes(words.hash, k)
    out = []
    for at, to in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if to - at >= k:
            out.append(np.unique(grams[at: to - k + 1]))
        elif to > at:
            out.append(gram_hashes(words.hash[at:to], to - at))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row lengths."""
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, kind))
