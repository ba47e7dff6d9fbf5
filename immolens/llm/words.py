"""Words and word shingles of Arrow text columns, as 64-bit hashes.

A word is a run of bytes other than ASCII white space (9 to 13 and 32), with
A-Z lower-cased. Arrow's text buffer is used as it is, a bounded number of
bytes at a time; a single longer text is one chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from immolens.llm.hashing import mix64, run_hashes

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PLACE = mix64(np.arange(101, 101 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)


@dataclass
class WordChunk:
    """The words of rows ``first .. first + len(bounds) - 1`` of a batch."""

    first: int
    hashes: np.ndarray        # one per word
    bounds: np.ndarray        # words of row i: bounds[i] .. bounds[i + 1]
    starts: np.ndarray        # byte positions within the row's text
    ends: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    if column.null_count:                                  # a null may still own bytes
        column = column.fill_null("")
        return text_buffer(column)
    return data, offsets


def word_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[WordChunk]:
    data, offsets = text_buffer(column)
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + chunk_bytes, side="right")) - 1
        b = min(max(b, a + 1), rows)
        yield _chunk(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], a)
        a = b


def _chunk(data: np.ndarray, offsets: np.ndarray, first: int) -> WordChunk:
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = run_hashes(_LOWER[data], starts, ends)
    base = np.repeat(offsets[:-1], np.diff(bounds))
    return WordChunk(first, hashes, bounds, starts - base, ends - base)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order (none if there are
    fewer words)."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:count] * _PLACE[0]
    for j in range(1, size):
        total = total + words[j:j + count] * _PLACE[j]
    return mix64(total)


def shingle_set(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text, ascending: runs of ``size`` words, or
    the whole sequence if it has fewer; none without words."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return mix64((words * _PLACE[:len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    return np.unique(shingle_hashes(words, size))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of every row of a text column."""
    for chunk in word_chunks(column):
        for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
            yield shingle_set(chunk.hashes[a:b])
