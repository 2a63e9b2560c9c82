"""Vectorised text helpers for tasks that read Arrow batches.

A batch's texts are one byte array with row offsets; NULL reads as empty. Words
are runs of bytes outside ``[\\x20\\x09-\\x0D]`` and never cross a row. Hashes are
64 bit; they identify words and shingles, so two different ones are confused
with a probability near 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CHUNK = 1 << 20  # bytes hashed at once
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its row offsets, without a Python string per row; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` text bytes, so that work arrays stay small; one long row is a piece of its own."""
    _, at = column_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row boundary the number of words before it."""
    inside = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, n of each at least."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: a prefix polynomial modulo 2**64, so the cost is per byte and not per span.

    The spans are in order and do not overlap. A piece of work ends at a span's
    end, so the work arrays hold one chunk, or one span if that is longer.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        part = data[low : ends[j - 1]]
        up, down = powers(max(len(part), _CHUNK if len(starts) > 1000 else 1) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def shingles(words_: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes row by row and the row offsets into them.

    A row with fewer than k words has its whole sequence as its one shingle, a
    row without words has none.
    """
    counts = np.diff(at)
    each = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    to = np.concatenate([[0], np.cumsum(each)])
    row = np.repeat(np.arange(len(counts)), each)
    first = np.arange(to[-1]) - to[row] + at[row] if len(row) else np.zeros(0, np.int64)
    length = np.minimum(counts, k)[row] if len(row) else np.zeros(0, np.int64)
    value = np.zeros(len(row), np.uint64)
    for i in range(k):
        has = length > i
        word = words_[np.minimum(first + i, max(len(words_) - 1, 0))] if len(words_) else value
        value = np.where(has, mix(value * np.uint64(0xA0761D6478BD642F) + word + np.uint64(i + 1)), value)
    keep = np.ones(len(row), bool)
    order = np.lexsort((value, row)) if len(row) else np.zeros(0, np.int64)
    value, row = value[order], row[order]
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[keep], np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(counts)))]).astype(np.int64)
