"""Whitespace words of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass handles; a longer text is handled alone.
CHUNK = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words of several texts, in order. `doc` is the text's index, `start` and `end` byte places in `data`."""

    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def bounds(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(len(self.offsets)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str = "text", size: int | None = None):
    """Slices of a batch whose text fits in `size` bytes (CHUNK by default), a longer text alone."""
    size = size or CHUNK
    if not batch.num_rows:
        return
    _, offsets = as_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def segments(text: bytes):
    """A long text in parts that end where white space is."""
    at = 0
    while at < len(text):
        to = min(len(text), at + CHUNK)
        while to < len(text) and text[to] not in b" \t\n\v\f\r":
            to += 1
        yield text[at:to]
        at = to


def words(column: pa.Array, lower: bool = True) -> Words:
    data, offsets = as_bytes(column)
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, doc, start, end)


def hashes(found: Words) -> np.ndarray:
    """A 64-bit value of each word."""
    if not len(found.start):
        return np.zeros(0, np.uint64)
    size = found.end - found.start
    first = np.cumsum(size) - size
    rel = np.arange(int(size.sum())) - np.repeat(first, size)
    place = rel + np.repeat(found.start, size)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(int(size.max()), _BASE, np.uint64))
        sums = np.add.reduceat((found.data[place].astype(np.uint64) + np.uint64(1)) * powers[rel], first)
        return mix(sums ^ (size.astype(np.uint64) << np.uint64(40)))


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit value of each run of `size` consecutive values, whatever text they are of."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = mix(out * _BASE + values[j : j + n])
    return out
