"""Words of Arrow text columns as numpy arrays: spans, 64-bit hashes, windows.

A column is one byte buffer with offsets; everything below works on whole buffers, so a
batch costs a few numpy passes and no loop over words. Batches are cut into blocks of
about ``BLOCK`` bytes of whole texts (a longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64, n + 1, 8 * column.offset)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``size`` text bytes each, with bytes and offsets of the column."""
    for batch in batches:
        data, offsets = buffer_of(batch.column(batch.schema.get_field_index(column)))
        at, n = 0, batch.num_rows
        while at < n:
            end = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1))
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def words_of(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of words before it (one more entry than texts).

    ``apart`` marks the bytes between words: white space, unless another table is given.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span. Spans are in order, not empty, and don't overlap."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers = np.multiply.accumulate(powers)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    within = np.arange(total) - np.repeat(first, lengths)
    if total == len(data) and starts[0] == 0:
        values = data
    else:
        values = data[within + np.repeat(starts, lengths)]
    terms = (values.astype(np.uint64) + np.uint64(1)) * powers[within]
    return mix(np.add.reduceat(terms, first) ^ (lengths.astype(np.uint64) * _MIX1))


def windows(hashes: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` words inside a text, and for each text the number of runs before it.

    A text with fewer words (at least one) has one run, all its words.
    """
    counts = np.diff(before)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_before = np.concatenate([[0], np.cumsum(runs)])
    total = int(out_before[-1])
    text = np.repeat(np.arange(len(counts)), runs)
    start = before[:-1][text] + np.arange(total) - out_before[:-1][text]
    left = before[1:][text] - start
    out = np.zeros(total, np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for k in range(n):
        out = out * _BASE + np.where(left > k, padded[start + k], np.uint64(k + 1))
    return mix(out), out_before
