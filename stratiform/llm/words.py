"""Words of Arrow text columns as numpy arrays of positions and 64-bit hashes.

A word is a maximal run of bytes that are not space, tab or a line end (``[^\\x20\\x09-\\x0D]+``). Texts are handled in windows
of a few MB, cut at white space, so memory does not grow with a text's length.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 2 << 20
ROWS = 1024

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Byte classes: 0 parts words; runs of one class are a word.
BY_SPACE = (~_SPACE).astype(np.uint8)
#: Letters, digits and bytes of other scripts on one side, punctuation on the other.
BY_KIND = BY_SPACE.copy()
BY_KIND[[b for b in range(33, 127) if not (chr(b).isalnum() or b == 95)]] = 2

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_TABLES = {False: _TABLE, True: _TABLE[_LOWER]}
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit hashes."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, WINDOW + 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """row: the text each word is in; start, end: bytes in ``data``; hash: of the word's bytes."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.row)

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=len(self.offsets) - 1)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes of every window of ``size`` words that lies in one text, and its first word's number."""
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value = self.hash[:n].copy()
        for k in range(1, size):
            value *= np.uint64(0xC2B2AE3D27D4EB4F)
            value += self.hash[k : k + n]
        first = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        return first, mix(value[first])


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Windows of about WINDOW bytes that end at a text's end, or in a longer text at white space."""
    at, end = 0, len(data)
    while at < end:
        to = at + WINDOW
        if to >= end:
            to = end
        else:
            cut = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if cut > at:
                to = cut
            else:
                while to < end:
                    gap = np.flatnonzero(classes[data[to : to + 65536]] == 0)
                    if len(gap):
                        to += int(gap[0])
                        break
                    to += 65536
                to = min(to, end)
                after = int(offsets[np.searchsorted(offsets, at, "right")])
                to = min(to, after) if after > at else to
        yield at, to
        at = to


def words_of(texts: pa.Array, lower: bool = True, classes: np.ndarray = BY_SPACE) -> Words:
    """Words of each text; with ``lower``, hashes treat A-Z as a-z."""
    data, offsets = text_buffers(texts)
    starts, ends, hashes = [], [], []
    table = _TABLES[lower]
    for at, to in _cuts(data, offsets, classes):
        part = data[at:to]
        kind = classes[part]
        edge = np.empty(len(part) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        inside = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, to)] - at
        edge[inside] = True
        bounds = np.flatnonzero(edge)
        real = kind[bounds[:-1]] != 0
        first, last = bounds[:-1][real], bounds[1:][real]
        power, inverse = _power(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[part] * power[: len(part)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * inverse[first]))
        starts.append(first + at)
        ends.append(last + at)
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    end = np.concatenate(ends) if ends else none
    value = np.concatenate(hashes) if hashes else none.astype(np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return Words(row, start, end, value, data, offsets)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ROWS rows and, unless one text is longer, about WINDOW bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = min(max(int(np.searchsorted(size, done + WINDOW, "right")), at + 1), at + ROWS)
            to = min(to, batch.num_rows)
            yield batch.slice(at, to - at)
            done, at = int(size[to - 1]), to


def distinct_per_row(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, one row after the other, and their bounds."""
    order = np.lexsort((value, row)) if len(row) and np.any(row[1:] < row[:-1]) else None
    if order is None:
        bounds = np.searchsorted(row, np.arange(rows + 1))
        value = value.copy()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            value[a:b].sort()
    else:
        row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[keep], value[keep]
    return value, np.searchsorted(row, np.arange(rows + 1))


def worker_memory(name: str, make):
    """A value that lives as long as the Python worker, so that later tasks in it find what earlier ones made."""
    held = sys.modules.setdefault("stratiform_worker_memory", types.ModuleType("stratiform_worker_memory")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
