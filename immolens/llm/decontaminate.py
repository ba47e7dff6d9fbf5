"""Benchmark decontamination by SimHash windows.

An item's fingerprint is the 64-bit SimHash of its weighted five-word
shingles (weight: log(1 + items / items that hold the shingle); a shingle of
no item weighs as one of a single item). A document is looked at through
windows as long as the item. Windows that share no shingle with any item of
their length cannot be similar to one, so fingerprints are computed, from
prefix sums, for the windows around shared shingles only.

Fingerprints are looked up in a multi-index: eight blocks of eight bits. Two
fingerprints within ``RADIUS`` = 23 differ in at most two bits in at least one
block, so the items found through the blocks' neighbourhoods are all items
within the radius. Each is verified: the weighted Jaccard similarity of the
window's and the item's shingles must reach 0.75. The expected distance at
that similarity is 11 bits, with a deviation of 3, if the item's shingles all
have the largest weight and the window repeats none. For other items (they
share shingles with other items, or repeat one) and windows the cosine, and so
the distance, is not bounded by the similarity: they are looked up by their
weighted overlap as well, from prefix sums over the item's own shingles, which
is exact.

Benchmark items are handled about ``ITEMS_PER_PASS`` at a time; a larger
benchmark takes more passes over the documents. The weights are those of the
whole benchmark in every pass: one aggregation gives the shingles that several
items hold (12 bytes each, sent with every pass); all others weigh alike.
Indexes are built one at a time and broadcast. ``decontaminated`` writes the
remaining rows between passes. Documents are not shuffled.

Cases: a null or empty text matches nothing, and an item without words is
matched by nothing. An item of fewer than five words matches where its words
occur in that order. A document shorter than an item is one window. Null ids
are carried along. Repeated rows are matched one by one. Very long texts are
processed whole; memory follows the window starts near shared shingles, a
bounded number at a time. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.llm.hashing import gather_runs, mix64
from immolens.llm.memory import thrifty
from immolens.llm.tables import stored
from immolens.llm.words import SHINGLE_WORDS, shingle_hashes, word_chunks

SIMILARITY = 0.75
RADIUS = 23
BLOCKS, BLOCK_BITS = 8, 8
ITEMS_PER_PASS = 4096
_WINDOWS_AT_ONCE = 1 << 14
_ALMOST = SIMILARITY - 1e-4     # sums of rounded weights

_NEAR_VALUES = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= RADIUS // BLOCKS


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1/-1 per bit of each shingle's hash."""
    bits = np.unpackbits(mix64(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, as rows of eight bytes, of rows of 64 sums."""
    return np.packbits(sums > 0, axis=1)


def _item_words(texts: pa.Array) -> list[np.ndarray]:
    texts = pa.array([t or "" for t in texts.to_pylist()], pa.string())
    return [c.hashes[a:b] for c in word_chunks(texts) for a, b in zip(c.bounds[:-1], c.bounds[1:])]


def _item_shingles(words: np.ndarray) -> np.ndarray:
    return shingle_hashes(words, min(len(words), SHINGLE_WORDS)) if len(words) else np.zeros(0, dtype=np.uint64)


class ItemIndex:
    """The multi-index of some of the benchmark's ``n_items`` items.
    ``repeated``: the shingles that several of all items hold, sorted, and by
    how many."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, repeated: tuple[np.ndarray, np.ndarray]):
        words = _item_words(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.words = [len(w) for w in words]
        sequences = [_item_shingles(w) for w in words]
        self.sets = [np.unique(s) for s in sequences]
        self.known = np.unique(np.concatenate([*self.sets, np.zeros(0, dtype=np.uint64)]))
        self.repeated, df = repeated
        self.weights = np.log1p(n_items / df).astype(np.float32)
        self.rare = math.log1p(n_items)
        self.totals = [float(self.weight(s).sum()) for s in self.sets]
        # the radius holds for items whose shingles weigh alike, the most possible, and do not repeat
        self.level = [len(q) == len(s) and bool((self.weight(s) == np.float32(self.rare)).all()) for q, s in zip(sequences, self.sets)]
        # items of one word count share windows: word count -> (items, fingerprints, block neighbourhoods, shingles)
        groups: dict[int, list[int]] = defaultdict(list)
        for k, n in enumerate(self.words):
            if n:
                groups[n].append(k)
        self.groups = {}
        for n, members in groups.items():
            prints = np.concatenate([_pack((_signs(s) * self.weight(s)[:, None]).sum(axis=0)[None]) for s in (sequences[k] for k in members)])
            near = [_NEAR_VALUES[:, prints[:, b]] for b in range(BLOCKS)]
            self.groups[n] = (members, prints, near, np.unique(np.concatenate([self.sets[k] for k in members])))
        self.holders = {n: _holders([self.sets[k] for k in g[0]], g[3]) for n, g in self.groups.items()}

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.repeated):
            return np.full(len(shingles), self.rare, dtype=np.float32)
        at = np.minimum(np.searchsorted(self.repeated, shingles), len(self.repeated) - 1)
        return np.where(self.repeated[at] == shingles, self.weights[at], np.float32(self.rare))

    def similarity(self, k: int, window: np.ndarray) -> float:
        window = np.unique(window)
        own = float(self.weight(window).sum())
        both = float(self.weight(np.intersect1d(window, self.sets[k], assume_unique=True)).sum())
        return both / (own + self.totals[k] - both)

    def matches(self, words: np.ndarray, sequences: dict[int, np.ndarray], hits: dict[int, np.ndarray]) -> list[tuple[int, int, int, float, int]]:
        """(item, first word, words, similarity, distance) of the best window
        per item. ``hits``: by word count, positions of shared shingles."""
        best: dict[int, tuple] = {}
        signed: dict[int, tuple[int, np.ndarray]] = {}
        for n, at in hits.items():
            members, prints, near, _ = self.groups[n]
            size = min(n, SHINGLE_WORDS)
            shingles = sequences[size]
            span = min(n - size + 1, len(shingles))                     # shingles in a window
            last = len(shingles) - span
            for starts, first in _near_starts(at, span, last):
                sums = _window_sums(self, shingles, starts, first, span)
                found = _pack(sums)
                close = np.zeros((len(found), len(members)), dtype=bool)
                for b in range(BLOCKS):
                    close |= near[b][found[:, b]]
                rows, cols = np.nonzero(close)
                distance = np.bitwise_count(found[rows] ^ prints[cols]).sum(axis=1)
                for r, c, d in zip(rows[distance <= RADIUS], cols[distance <= RADIUS], distance[distance <= RADIUS]):
                    k, start = members[c], int(starts[r])
                    s = self.similarity(k, shingles[start:start + span])
                    if s >= SIMILARITY and (k not in best or (-s, start) < (-best[k][3], best[k][1])):
                        best[k] = (k, start, min(span + size - 1, len(words)), s, int(d))
            for m, start in self._by_overlap(n, shingles, at, span):
                k = members[m]
                s = self.similarity(k, shingles[start:start + span])
                if s >= SIMILARITY and (k not in best or (-s, start) < (-best[k][3], best[k][1])):
                    print_ = _pack(_window_sums(self, shingles, np.array([start]), start, span))[0]
                    best[k] = (k, start, min(span + size - 1, len(words)), s, int(np.bitwise_count(print_ ^ prints[m]).sum()))
        return [best[k] for k in sorted(best)]

    def _by_overlap(self, n: int, shingles: np.ndarray, at: np.ndarray, span: int):
        """(member of the group, start) of the windows that may reach the
        similarity and that the radius is not sure to hold."""
        members, _, _, shared = self.groups[n]
        first, holder = self.holders[n]
        hit = np.unique(shingles[at])
        slot = np.searchsorted(shared, hit)
        counts = first[slot + 1] - first[slot]
        owner = holder[gather_runs(np.arange(len(holder)), first[slot], counts)]
        held = np.bincount(owner, weights=np.repeat(self.weight(hit), counts), minlength=len(members))
        likely = [int(m) for m in np.unique(owner) if held[m] >= _ALMOST * self.totals[members[m]]]
        if not likely:
            return
        last = len(shingles) - span
        repeats = _repeating(shingles, span)
        any_repeats = bool(repeats.any())
        for m in likely:
            k = members[m]
            if self.level[k] and not any_repeats:
                continue
            own = at[np.isin(shingles[at], self.sets[k])]
            sums = np.concatenate([[0.0], np.cumsum(self.weight(shingles[own]), dtype=np.float64)])
            for starts, x in _near_starts(own, span, last):
                both = sums[np.searchsorted(own, starts + span)] - sums[np.searchsorted(own, starts)]
                all_ = np.concatenate([[0.0], np.cumsum(self.weight(shingles[x:int(starts[-1]) + span]), dtype=np.float64)])
                weight = all_[span:] - all_[:-span]
                again = repeats[starts]
                # what a window repeats counts once: its overlap is at most this
                ok = np.where(again, both >= _ALMOST * self.totals[k], both >= _ALMOST * (weight + self.totals[k] - both))
                for start in starts[ok & again if self.level[k] else ok]:
                    yield m, int(start)


def _holders(sets: list[np.ndarray], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ``shared`` shingles the sets that hold it: the first
    place of each shingle, and the sets' numbers in order of the shingles."""
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    first = np.searchsorted(flat[order], shared)
    return np.append(first, len(flat)), np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]


def _repeating(shingles: np.ndarray, span: int) -> np.ndarray:
    """Whether the window at each start holds a shingle more than once."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order[1:]] == shingles[order[:-1]]
    before, after = order[:-1][same], order[1:][same]
    close = after - before < span
    before, after = before[close], after[close]
    starts = len(shingles) - span + 1
    change = np.zeros(len(shingles) + 1, dtype=np.int64)
    np.add.at(change, np.maximum(after - span + 1, 0), 1)
    np.add.at(change, before + 1, -1)
    return np.cumsum(change)[:starts] > 0


def _near_starts(at: np.ndarray, span: int, last: int):
    """Window starts whose window holds a position of ``at``, in runs of a
    bounded length: (starts, first start)."""
    low, high = np.maximum(at - span + 1, 0), np.minimum(at, last)
    low = np.minimum(low, last)
    a, b = int(low[0]), int(high[0])
    runs = []
    for x, y in zip(low.tolist(), high.tolist()):
        if x > b + 1:
            runs.append((a, b))
            a, b = x, y
        b = max(b, y)
    runs.append((a, b))
    for a, b in runs:
        for first in range(a, b + 1, _WINDOWS_AT_ONCE):
            yield np.arange(first, min(b + 1, first + _WINDOWS_AT_ONCE)), first


def _window_sums(index: ItemIndex, shingles: np.ndarray, starts: np.ndarray, first: int, span: int) -> np.ndarray:
    """Weighted sign sums of the windows at consecutive ``starts``."""
    part = shingles[first:int(starts[-1]) + span]
    prefix = np.zeros((len(part) + 1, 64), dtype=np.float64)
    np.cumsum(_signs(part) * index.weight(part)[:, None], axis=0, out=prefix[1:])
    return prefix[span:] - prefix[:-span]


def batch_matches(index: ItemIndex, column: pa.Array):
    """(row, item, first word, words, similarity, distance) in a batch."""
    sizes = sorted({min(n, SHINGLE_WORDS) for n in index.groups})
    for chunk in word_chunks(column):
        bounds = chunk.bounds
        hit_rows: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        per_size = {size: shingle_hashes(chunk.hashes, size) for size in sizes}
        for size in sizes:
            values = per_size[size]
            common = _members(values, index.known)
            if not len(common):
                continue
            row = np.searchsorted(bounds, common, side="right") - 1
            inside = common + size <= bounds[row + 1]                  # not across texts
            common, row = common[inside], row[inside]
            for n, (_, _, _, shared) in index.groups.items():
                if min(n, SHINGLE_WORDS) == size:
                    own = np.isin(values[common], shared)
                    for r in np.unique(row[own]):
                        hit_rows[int(r)][n] = common[own & (row == r)] - bounds[r]
        for r in sorted(hit_rows):
            a, b = int(bounds[r]), int(bounds[r + 1])
            sequences = {size: per_size[size][a:b - size + 1] for size in sizes if b - a >= size}
            for m in index.matches(chunk.hashes[a:b], sequences, hit_rows[r]):
                yield (chunk.first + r, *m)


def _members(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Positions of ``values`` that occur in the sorted array ``known``."""
    if not len(known) or not len(values):
        return np.zeros(0, dtype=np.int64)
    table = np.zeros(1 << 16, dtype=bool)                             # most values fail on 16 bits
    table[known & np.uint64(0xFFFF)] = True
    maybe = np.flatnonzero(table[values & np.uint64(0xFFFF)])
    at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
    return maybe[known[at] == values[maybe]]


def _repeated_shingles(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several items hold, sorted, and by how many."""
    @thrifty
    def distinct(batches):
        for batch in batches:
            for w in _item_words(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_item_shingles(w)).view(np.int64))], names=["shingle"])

    found = items.select("text").mapInArrow(distinct, "shingle long").groupBy("shingle").count().where("count > 1").toArrow()
    shingles = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found.column("count").to_numpy()[order]


def _indexes(benchmark: DataFrame, item_col: str, text_col: str):
    """A broadcast index per pass, and whether it is the last one."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    n_items = items.count()
    repeated = _repeated_shingles(items)
    passes = max(1, math.ceil(n_items / ITEMS_PER_PASS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    for p in range(passes):
        own = [tuple(r) for r in items.where(part == p).orderBy("item_id", "text").collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(ItemIndex(own, n_items, repeated)), p == passes - 1


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, start_word,
    n_words, similarity and distance of the best window."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
    names = ["doc_id", "item_id", "start_word", "n_words", "similarity", "distance"]

    def finder(sent):
        @thrifty
        def find(batches):
            index = sent.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], index.ids[k], start, n, s, d) for r, k, start, n, s, d in batch_matches(index, batch.column(1))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
        return find

    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"
    found = [docs.mapInArrow(finder(sent), schema) for sent, _ in _indexes(benchmark, item_col, item_text_col)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no benchmark item."""
    at = docs.columns.index(text_col)

    def keeper(sent):
        @thrifty
        def keep(batches):
            index = sent.value
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[m[0] for m in batch_matches(index, batch.column(at))]] = False
                yield batch.filter(pa.array(clean))
        return keep

    for sent, last in _indexes(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(keeper(sent), docs.schema)
        docs = docs if last else stored(docs, "clean")             # a task holds one index
    return docs
