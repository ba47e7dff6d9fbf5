"""Interning the word n-grams of a block of text in an open-addressed table.

The words of a block lie in one byte buffer, joined by single spaces, so an
n-gram is a slice of it and no Python object is made per occurrence. Its key
is the XXH64 hash of the slice, computed for all occurrences at once. The
table probes linearly; an occurrence belongs to a slot only if the key and
then the bytes are equal, so different n-grams never share a slot. Every slot
has the n-gram's bucket and its number of occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash

from immolens.llm.words import text_buffer

BLOCK_WORDS = 1 << 17           # words per table: bounds memory, whatever the length of a text
READ_BYTES = 1 << 20            # text tokenised at a time (a longer text by itself)

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_PAD = 8
_SHORT = 96                     # bytes; longer slices are rare and handled one by one

_CRC = np.arange(256, dtype=np.uint32)          # CRC-32 of one byte, reflected polynomial 0xEDB88320
for _ in range(8):
    _CRC = (_CRC >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (_CRC & np.uint32(1)))


def _rotl(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc, lane):
    return _rotl(acc + lane * _P2, 31) * _P1


def lanes_of(buffer: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word at every byte position of a buffer that
    ends in ``_PAD`` spare bytes."""
    return np.ndarray(shape=(len(buffer) - _PAD + 1,), dtype="<u8", buffer=buffer, strides=(1,))


def xxh64(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of the slices ``starts, lengths`` of a padded buffer."""
    far = np.flatnonzero(lengths > _SHORT)
    if len(far):
        h, near, view = np.empty(len(starts), dtype=np.uint64), np.flatnonzero(lengths <= _SHORT), memoryview(buffer)
        h[near] = xxh64(buffer, starts[near], lengths[near])
        h[far] = [xxhash.xxh64_intdigest(view[a:a + n]) for a, n in zip(starts[far].tolist(), lengths[far].tolist())]
        return h
    lanes = lanes_of(buffer)
    at = starts.astype(np.int64)
    h = np.full(len(at), _P5, dtype=np.uint64)
    long = np.flatnonzero(lengths >= 32)
    if len(long):
        p, left = at[long], lengths[long].astype(np.int64)
        acc = [np.full(len(long), v, dtype=np.uint64) for v in
               (np.uint64((int(_P1) + int(_P2)) % 2**64), _P2, np.uint64(0), np.uint64(-int(_P1) % 2**64))]
        live = np.arange(len(long))
        while len(live):
            for j in range(4):
                acc[j][live] = _round(acc[j][live], lanes[p[live] + 8 * j])
            p[live] += 32
            left[live] -= 32
            live = live[left[live] >= 32]
        mixed = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for v in acc:
            mixed = (mixed ^ _round(np.uint64(0), v)) * _P1 + _P4
        h[long], at[long] = mixed, p
    h += lengths.astype(np.uint64)
    left = starts + lengths - at
    live = np.flatnonzero(left >= 8)
    while len(live):
        h[live] = _rotl(h[live] ^ _round(np.uint64(0), lanes[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        left[live] -= 8
        live = live[left[live] >= 8]
    live = np.flatnonzero(left >= 4)
    if len(live):
        h[live] = _rotl(h[live] ^ ((lanes[at[live]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at[live] += 4
        left[live] -= 4
    live = np.flatnonzero(left > 0)
    while len(live):
        h[live] = _rotl(h[live] ^ (buffer[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        left[live] -= 1
        live = live[left[live] > 0]
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def same_bytes(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the slices at ``a`` and ``b`` hold the same bytes."""
    lanes, view = lanes_of(buffer), memoryview(buffer)
    equal = np.ones(len(a), dtype=bool)
    far = np.flatnonzero(lengths > _SHORT)
    equal[far] = [view[i:i + n] == view[j:j + n] for i, j, n in zip(a[far].tolist(), b[far].tolist(), lengths[far].tolist())]
    live, done = np.flatnonzero(lengths <= _SHORT), 0
    while len(live):
        left = lengths[live] - done
        unused = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)       # bits past the end
        differ = ((lanes[a[live] + done] ^ lanes[b[live] + done]) << unused) != 0
        equal[live[differ]] = False
        done += 8
        live = live[~differ & (left > 8)]
    return equal


def crc32s(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of every slice: byte by byte for all short slices at
    once, longest first."""
    out = np.empty(len(starts), dtype=np.int64)
    view = memoryview(buffer)
    for i in np.flatnonzero(lengths > _SHORT).tolist():
        out[i] = crc32(view[starts[i]:starts[i] + lengths[i]])
    order = np.flatnonzero(lengths <= _SHORT)
    order = order[np.argsort(-lengths[order].astype(np.int16), kind="stable")]
    at, falling = starts[order], -lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(int(-falling[0]) if len(order) else 0):
        n = int(np.searchsorted(falling, -j))                # slices longer than j
        crc[:n] = _CRC[(crc[:n] ^ buffer[at[:n] + j]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


class NgramTable:
    """Open addressing with linear probing over the occurrences of a block."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int,
                 keys: np.ndarray | None = None):
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        self.owner = np.full(size, -1, dtype=np.int64)       # slot -> the occurrence that stands for it
        keys = xxh64(buffer, starts, lengths) if keys is None else keys
        self.slot_ids = self._interned(buffer, starts, lengths, keys, np.int64(size - 1))
        self.count = np.bincount(self.slot_ids, minlength=size) if len(starts) else np.zeros(size, dtype=np.int64)
        self.bucket = np.zeros(size, dtype=np.int64)
        used = np.flatnonzero(self.owner >= 0)
        stands = self.owner[used]
        self.bucket[used] = crc32s(buffer, starts[stands], lengths[stands]) % buckets

    def _interned(self, buffer, starts, lengths, keys, mask) -> np.ndarray:
        probe = (keys & np.uint64(mask)).astype(np.int64)
        slots = np.empty(len(keys), dtype=np.int64)
        pending = np.arange(len(keys))
        while len(pending):
            at = probe[pending]
            free = self.owner[at] < 0
            self.owner[at[free]] = pending[free]             # of those that meet at a free slot one stays
            owner = self.owner[at]
            match = (keys[owner] == keys[pending]) & (lengths[owner] == lengths[pending])
            test = np.flatnonzero(match & (owner != pending))
            match[test] = same_bytes(buffer, starts[owner[test]], starts[pending[test]], lengths[pending[test]])
            slots[pending[match]] = at[match]
            pending = pending[~match]
            probe[pending] = (probe[pending] + 1) & mask
        return slots


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, bounds): the words of some texts joined by single
    spaces; the words of row i are ``bounds[i] .. bounds[i + 1]``."""
    lower = _LOWER[data]
    solid = _IN_WORD[lower]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:len(data)]
    bounds = np.searchsorted(np.flatnonzero(begins), offsets)
    place = np.flatnonzero(solid)
    word = np.cumsum(begins)[place] - 1
    moved = np.arange(len(place)) + word                     # one space before every word but the first
    buffer = np.full((int(moved[-1]) + 1 if len(moved) else 0) + _PAD, 32, dtype=np.uint8)
    buffer[moved] = lower[place]
    starts = moved[begins[place]]
    ends = np.append(starts[1:] - 1, len(buffer) - _PAD) if len(starts) else starts
    return buffer, starts, ends, bounds


class Block:
    """All n-grams that start at some words of a batch: the row and the slot
    of every occurrence, and the table."""

    def __init__(self, buffer, starts, ends, rows, last_word, a, b, orders, buckets):
        first, lengths, row = [], [], []
        for n in orders:
            i = np.arange(a, b)
            i = i[i + n <= last_word[a:b]]
            first.append(starts[i])
            lengths.append(ends[i + n - 1] - starts[i])
            row.append(rows[i])
        self.rows = np.concatenate(row)
        self.table = NgramTable(buffer, np.concatenate(first), np.concatenate(lengths), buckets)


def ngram_blocks(column: pa.Array, orders: range, buckets: int) -> Iterator[tuple[int, np.ndarray, Iterator[Block]]]:
    """For consecutive rows of a text column: (first row, words per row, their
    blocks). The blocks are made one at a time."""
    data, offsets = text_buffer(column)
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + READ_BYTES, side="right")) - 1
        b = min(max(b, a + 1), rows)
        buffer, starts, ends, bounds = _words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        of_row = np.repeat(np.arange(b - a), np.diff(bounds))
        last_word = bounds[1:][of_row]
        yield a, np.diff(bounds), (
            Block(buffer, starts, ends, of_row, last_word, i, min(i + BLOCK_WORDS, len(starts)), orders, buckets)
            for i in range(0, len(starts), BLOCK_WORDS))
        a = b
