"""Flat numpy views of Arrow string batches and 64-bit hashes of words and word n-grams.

All functions work on one flat array for many texts; a batch is cut into chunks
of about ``CHUNK_BYTES`` so that the temporaries stay small whatever the number
of rows.  A single longer text makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (fixed public constants): a bijection on 64 bits."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POW = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """1, B, B^2, ... modulo 2^64, at least ``n`` of them."""
    global _POW
    if len(_POW) < n:
        base = np.full(max(n, 1024) - 1, 0xD6E8FEB86659FD93, dtype=np.uint64)
        _POW = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(base)])
    return _POW


def string_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    if not len(col):
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, len(col))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each half-open span of ``values`` (already mixed to 64 bits); spans must not be empty and must be in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    at = np.arange(total) - np.repeat(first, lens)  # place inside the span
    h = values[np.repeat(starts, lens) + at] * powers(int(lens.max()))[at]
    return mix64(np.add.reduceat(h, first) + lens.astype(np.uint64) * _ODD)


def ascii_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words ``[^\\x20\\x09-\\x0D]+`` of each text: (starts, ends, words per text)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    word = (data != 32) & ((data < 9) | (data > 13))
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner] = word[inner]  # a word never runs on into the next text
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order: (hashes, hashes per text).

    A text with fewer than k words has its whole word sequence as one shingle;
    one without words has none.
    """
    low = lower_ascii(data)
    starts, ends, per = ascii_words(low, offsets)
    words = spans_hash(_BYTE[low], starts, ends)
    n = len(words)
    count = np.where(per >= k, per - k + 1, (per > 0).astype(per.dtype))
    if not n:
        return words, count
    at = np.cumsum(per) - per  # first word of each text
    own = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(at, count) + own
    size = np.repeat(np.minimum(per, k), count)
    h = size.astype(np.uint64) * _ODD
    p = powers(k + 1)
    for j in range(k):
        take = np.minimum(begin + j, n - 1)
        h += np.where(j < size, words[take] * p[j], U(0))
    return mix64(h), count
