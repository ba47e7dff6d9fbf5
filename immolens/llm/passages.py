"""Near-duplicate passages by compact windows.

A document is the sequence of its five-word shingles. For each of ``HASHES``
hash functions, every passage has a minimum, and passages of one document
with the minimum at the same position c form a compact window (l, c, r): all
[i, j] with l <= i <= c <= j <= r. These windows are the nodes of the
Cartesian tree over the hashes; only nodes at least ``MIN_WORDS`` wide matter.
Their centres are the minima of the sliding windows of that width, and the
smaller neighbours that bound a node are such centres themselves, so the
tree is built on a few centres per document, with array operations.

Two passages that share a signature lie in windows with equal centre
shingles. A window is joined under two keys: its centre with the minimum, by
another function, of the far half of the ``_SIDE`` shingles to the left, and
likewise to the right; a passage of full width covers one of the sides. (Only
the far half: a short line that many documents hold would fill the near half,
and its holders would all meet for nothing.) Windows meet if the intervals
around both centres are wide enough together:
1. Under each key all meet the one of the smallest document id. A task links
   equal keys of its own rows first and sends one of them on, so a passage that
   very many documents share does not pile up under its key.
2. Windows whose centre lies in no passage verified so far meet the earlier
   documents of their key, in salted blocks of about ``BLOCK_WINDOWS`` on both
   sides. Of a document's windows under one key, the up to three that
   reach furthest (left, right, together) stand for all.

Each pair of documents is then verified on the texts: shingles shared near
the pair's diagonals are gathered into passages, and a passage counts if both
sides have at least ``MIN_WORDS`` words and a Jaccard similarity of 0.75.

Text that repeats a period of up to ``MIN_WORDS`` words over and over would
have a window at each repeat, and two such texts would be compared at all
their shifts. So all this is done on texts whose periodic runs are cut down to
the length that still holds each of their passages; the passages found are
given by their places in the whole texts, and a passage that lies in a run is
the whole run. In a run of one shingle both parts of a key would be that
shingle: there the second part is the shingle next to the run, which a passage
covers that is longer than the run, and a run as long as a passage has a key
of its own. So documents do not meet for a run that is too short.

Cases: null, empty and short texts (fewer than ``MIN_WORDS`` words) have no
passage. Rows without id take no part. Rows that repeat an id are one
document, of which one row is compared. Passages that repeat within one
document only are not reported. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.hashing import gather_runs, mix64
from immolens.llm.memory import thrifty
from immolens.llm.neardup import BROADCAST_IDS
from immolens.llm.tables import stored
from immolens.llm.words import SHINGLE_WORDS, shingle_hashes, word_chunks

MIN_WORDS = 50
HASHES = 4
SIMILARITY = 0.75
_WIDTH = MIN_WORDS - SHINGLE_WORDS + 1          # shingles in the shortest passage
_SIDE = _WIDTH // 2 + 1                         # shingles on the covered side, with the centre
_FAR = _SIDE // 2                               # of them, those furthest from the centre
_SEEDS = mix64(np.arange(1, HASHES + 2, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_CHUNK = 2 << 20
_SHIFT = 8                                      # words that may be inserted or lost along a passage
_GAP = 16
_PROBE = 12                                     # every how many words a period is looked for at first
BLOCK_WINDOWS = 1024
MAX_PARTITIONS = 20_000
MARGIN = 4 * _WIDTH                             # shingles compared on both sides of the windows at first


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every window of ``width``."""
    at = np.arange(len(values))
    low, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        right, left_at, right_at = low[step:], at[:-step], at[step:]
        left = low[:-step]
        take = left <= right
        at, low = np.where(take, left_at, right_at), np.where(take, left, right)
        reach += step
    return at


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (as np.minimum) of every window of ``width``."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = best(values[:-step], values[step:])
        reach += step
    return values


def _smaller_before(values: np.ndarray, docs: np.ndarray, strict: bool) -> np.ndarray:
    """Index of the nearest earlier value of the same document that is smaller
    (or equal, unless ``strict``); -1 if there is none."""
    p = np.arange(-1, len(values) - 1)

    def open_(i):
        ok = p[i] >= 0
        j = np.maximum(p[i], 0)
        same = ok & (docs[j] == docs[i])
        larger = values[j] >= values[i] if strict else values[j] > values[i]
        return same & larger, ok & ~same

    active = np.arange(len(values))
    while len(active):
        larger, other = open_(active)
        p[active[other]] = -1
        active = active[larger]
        p[active] = p[p[active]]
    return p


def compact_windows(values: np.ndarray, bounds: np.ndarray, width: int = _WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r), inclusive, of the compact windows at least ``width`` wide of
    several documents laid end to end (document i: ``bounds[i]..bounds[i+1]``)."""
    none = np.zeros(0, dtype=np.int64)
    if len(values) < width:
        return none, none, none
    least = _sliding(np.minimum, values, width)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(least)]
    least[np.arange(width, len(least) + width) > bounds[doc + 1]] = 0       # windows that reach into the next document
    edge = np.zeros(width - 1, dtype=least.dtype)
    # minima of some window; of equal ones in a window only the leftmost is a centre, the others turn out too narrow
    c = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge]), width) == values)
    if not len(c):
        return none, none, none
    doc = np.searchsorted(bounds, c, side="right") - 1
    v = values[c]
    before = _smaller_before(v, doc, strict=False)
    after = len(c) - 1 - _smaller_before(v[::-1], doc[::-1], strict=True)[::-1]
    left = np.where(before >= 0, c[np.maximum(before, 0)] + 1, bounds[doc])
    right = np.where(after < len(c), c[np.minimum(after, len(c) - 1)] - 1, bounds[doc + 1] - 1)
    wide = right - left + 1 >= width
    return left[wide], c[wide], right[wide]


def _window_keys(shingles: np.ndarray, bounds: np.ndarray):
    """Keys, centre positions (in the chunk), left and right reach."""
    side = mix64(shingles ^ _SEEDS[-1])
    side_at = _sliding_argmin(side, _FAR) if len(side) >= _FAR else np.zeros(0, dtype=np.int64)
    out = []
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = shingles[1:] != shingles[:-1]
    new[bounds[:-1][bounds[:-1] < len(shingles)]] = True
    starts = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    ends = np.append(starts[1:], len(shingles)) - 1
    for f in range(HASHES):
        l, c, r = compact_windows(mix64(shingles ^ _SEEDS[f]), bounds)
        if not len(c):
            continue
        doc = np.searchsorted(bounds, c, side="right") - 1
        s, e = starts[run[c]], ends[run[c]]
        for tag, first in ((1, c + _SIDE - _FAR), (2, c - _SIDE + 1)):
            ok = (first >= bounds[doc]) & (first + _FAR <= bounds[doc + 1])
            at = side_at[first[ok]]
            ok[ok] = (at < s[ok]) | (at > e[ok])
            key = mix64(shingles[c[ok]] * np.uint64(2 * f + 1) + side[side_at[first[ok]]] * np.uint64(3) + np.uint64(tag))
            out.append((key, c[ok], (c - l)[ok], (r - c)[ok]))
        long_ = (c == s) & (e - s > _SIDE - _FAR)                           # the run's first window reaches furthest
        for tag, ok, at, near in ((3, (e + 1 < bounds[doc + 1]) & (r > e), e, e + 1), (4, (s > bounds[doc]) & (l < s), s, s - 1),
                                  (5, e - s + 1 >= _WIDTH, s, s)):
            ok = ok & long_
            key = mix64(shingles[c[ok]] * np.uint64(2 * f + 1) + side[near[ok]] * np.uint64(3) + np.uint64(tag))
            out.append((key, at[ok], (at - l)[ok], (r - at)[ok]))
    if not out:
        return None
    return tuple(np.concatenate(x) for x in zip(*out))


def _without_long_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Indices of the words that stay when each run of a period of up to
    ``MIN_WORDS`` words is cut down, in its middle and by whole periods, to the
    shortest length that still holds every passage of ``MIN_WORDS`` words of it."""
    kept, docs = np.arange(len(words)), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    w, d, probed = words, docs, None
    for q in range(1, MIN_WORDS + 1):
        if probed is None:
            probed = [np.ascontiguousarray(w[k::_PROBE]) for k in range(_PROBE)]
        later = probed[q % _PROBE][q // _PROBE:]
        probes = later == probed[0][:len(later)]
        whole = MIN_WORDS // _PROBE                                         # probes that a long run holds at least
        if not _sliding(np.logical_and, probes, whole).any():
            continue
        same = np.concatenate([[False], (w[q:] == w[:-q]) & (d[q:] == d[:-q]), [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        first, length = edges[::2], np.diff(edges)[::2] + q
        excess = np.maximum(length - (MIN_WORDS + q - 1), 0) // q * q
        first, length, excess = first[excess > 0], length[excess > 0], excess[excess > 0]
        if not len(first):
            continue
        change = np.zeros(len(w) + 1, dtype=np.int64)
        begin = first + (length - excess) // 2
        np.add.at(change, begin, 1)
        np.add.at(change, begin + excess, -1)
        stay = np.cumsum(change[:-1]) == 0
        kept, w, d, probed = kept[stay], w[stay], d[stay], None
    return kept


def _pack(position, left, right):
    return (position << 32) | (np.minimum(left, 0xFFFF) << 16) | np.minimum(right, 0xFFFF)


BUCKET_BYTES = 32 << 20        # of text whose windows make one bucket of keys
_BLOBS = "bucket int, keys binary, docs binary, ats binary, shared binary, mates binary, mate_ats binary"
_CROWDED = "key long, doc long, at long, a long, a_at long"


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, all first bytes before all second ones: most planes are
    then nearly constant, and the exchange's compression takes them."""
    return values.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(blobs: pa.ChunkedArray) -> np.ndarray:
    parts = [np.frombuffer(b.as_buffer(), dtype=np.uint8).reshape(8, -1).T.copy().view(np.int64)[:, 0] for b in blobs if len(b.as_buffer())]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def window_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    """Keyed windows (key, doc, packed position and reach), many to a row, by
    bucket of their keys. Of the windows of a key in a task's chunk the first
    goes to the key's bucket, with the mark whether the chunk has the key in
    several documents; if so the others have met the first, their mate, and
    are dealt to any bucket."""
    @thrifty
    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in word_chunks(batch.column(1), _CHUNK):
                stay = _without_long_runs(chunk.hashes, chunk.bounds)
                edges = np.searchsorted(stay, chunk.bounds)
                shingles, bounds = _chunk_shingles(chunk.hashes[stay], edges)
                found = _window_keys(shingles, bounds)
                if found is None:
                    continue
                key, c, left, right = found
                row = np.searchsorted(bounds, c, side="right") - 1
                at = _pack(c - bounds[row], left, right)
                owner = ids[chunk.first + row]
                order = np.lexsort((at, owner, key))
                key, owner, at = key[order], owner[order], at[order]
                first = np.ones(len(key), dtype=bool)
                first[1:] = key[1:] != key[:-1]
                head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
                group = np.cumsum(first) - 1
                company = np.zeros(int(group[-1]) + 1, dtype=bool)          # keys that several documents hold
                company[group[owner != owner[head]]] = True
                shared = company[group]
                spread = mix64(key + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64))
                bucket = (np.where(first, key, spread) % np.uint64(buckets)).astype(np.int32)
                taken = np.flatnonzero(first | shared)
                taken = taken[np.lexsort((at[taken], owner[taken], ~first[taken], bucket[taken]))]
                cuts = np.flatnonzero(np.diff(bucket[taken])) + 1
                out = []
                for part in np.split(taken, cuts):
                    own, met = part[first[part]], part[~first[part]]
                    h = head[met]
                    out.append((int(bucket[part[0]]), _planes(key[part]), _planes(owner[part]), _planes(at[part]),
                                np.packbits(shared[own]).tobytes(), _planes(owner[h]), _planes(at[h])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 6)],
                                                 names=["bucket", "keys", "docs", "ats", "shared", "mates", "mate_ats"])

    return docs.mapInArrow(emit, _BLOBS)


@thrifty
def _meet(_, blobs):
    """The windows of a bucket whose keys several documents hold, with the
    one of the smallest document id."""
    key, doc, at = (_numbers(blobs.column(c)) for c in ("keys", "docs", "ats"))
    mate, mate_at = _numbers(blobs.column("mates")), _numbers(blobs.column("mate_ats"))
    first, shared = np.ones(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    k = 0
    for n, m, marks in zip(blobs.column("keys"), blobs.column("mates"), blobs.column("shared")):
        n, m = len(n.as_buffer()) // 8, len(m.as_buffer()) // 8             # the last m of the n windows have a mate
        shared[k:k + n - m] = np.unpackbits(np.frombuffer(marks.as_buffer(), dtype=np.uint8), count=n - m)
        first[k + n - m:k + n] = False
        k += n
    met = ~first
    out = [key[met], doc[met], at[met], mate, mate_at]
    key, doc, at, shared = key[first], doc[first], at[first], shared[first]
    if len(key):
        order = np.argsort(key, kind="stable")
        same = np.append(False, key[order][1:] == key[order][:-1])
        several = same | np.append(same[1:], False)                         # most keys are alone
        order = order[several | shared[order]]
        order = order[np.lexsort((at[order], doc[order], key[order]))]
        key, doc, at, shared = key[order], doc[order], at[order], shared[order]
    if len(key):
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        least, most = np.repeat(starts, sizes), np.repeat(starts + sizes - 1, sizes)
        kept = shared | (doc[least] != doc[most])
        out = [np.concatenate(p) for p in zip(out, (key[kept], doc[kept], at[kept], doc[least][kept], at[least][kept]))]
    return pa.table([pa.array(c, pa.int64()) for c in out], names=["key", "doc", "at", "a", "a_at"])


def crowded_windows(docs: DataFrame) -> DataFrame:
    """(key, doc, at, a, a_at): the windows of keys that several documents
    hold, each with the one it meets in the first round."""
    size = docs.agg(F.sum(F.octet_length(docs.columns[1]).cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    blobs = window_blobs(docs, buckets).repartition(min(buckets, MAX_PARTITIONS), "bucket")
    return blobs.groupBy("bucket").applyInArrow(_meet, _CROWDED)


def _left(c: str) -> Column:
    return F.shiftright(F.col(c), 16).bitwiseAND(0xFFFF)


def _right(c: str) -> Column:
    return F.col(c).bitwiseAND(0xFFFF)


def _wide_pairs(met: DataFrame) -> DataFrame:
    """(a, b, diagonal, lo, hi) of the pairs (a, a_at, b, b_at) that are wide
    enough together, with the first and last position in a on the diagonal."""
    wide = F.least(_left("a_at"), _left("b_at")) + F.least(_right("a_at"), _right("b_at")) + 1 >= _WIDTH
    place = F.shiftright("a_at", 32)
    diagonal = F.floor((F.shiftright("b_at", 32) - place) / _SHIFT).cast("int")
    return (met.where("a < b").where(wide).groupBy("a", "b", diagonal.alias("diagonal"))
            .agg(F.min(place).cast("int").alias("lo"), F.max(place).cast("int").alias("hi")))


def _by_pair(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("diagonal", "lo", "hi"))).alias("diagonals"))


def candidate_pairs(crowded: DataFrame) -> DataFrame:
    """(a, b, diagonals) of the first round: documents a < b with windows that
    may hold a common passage, and the positions of b relative to a, in steps
    of ``_SHIFT``."""
    return _by_pair(_wide_pairs(crowded.select("a", "a_at", F.col("doc").alias("b"), F.col("at").alias("b_at"))))


def _covered(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc_id").alias("_doc"), F.col("start_word").alias("_from"),
                        (F.col("start_word") + F.col("n_words") - SHINGLE_WORDS).alias("_to"))


def uncovered(windows: DataFrame, found: DataFrame) -> DataFrame:
    """The windows whose centre lies in no passage of ``found``."""
    centre = F.shiftright("at", 32)
    return windows.join(_covered(found), (F.col("doc") == F.col("_doc")) & (centre >= F.col("_from")) & (centre <= F.col("_to")), "left_anti")


def open_windows(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """(key, doc, at) of the windows that no passage in ``found`` covers,
    without those of the smallest document of their key."""
    least = crowded.groupBy("key").agg(F.min("doc").alias("least"))
    return uncovered(crowded, found).join(least, "key").where("doc > least").select("key", "doc", "at")


# of a document's windows under one key, the ones that reach furthest stand for all
def _furthest() -> Column:
    reach = [F.max_by("at", F.struct(r.alias("r"), "at")) for r in (_left("at"), _right("at"), _left("at") + _right("at"))]
    return F.array_distinct(F.array(*reach)).alias("_at")


def _without(met: DataFrame, done: DataFrame) -> DataFrame:
    """The wide pairs among the windows that met, without the diagonals of
    ``done`` (a, b, diagonal)."""
    return _wide_pairs(met).join(done, ["a", "b", "diagonal"], "left_anti")


def open_pairs(crowded: DataFrame, asking: DataFrame, done: DataFrame) -> DataFrame:
    """(a, b, diagonals) of the last round: the windows ``asking`` with all
    earlier ones of their key, without ``done``."""
    asked = asking.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_WINDOWS).cast("int").alias("groups"))
    offering = stored(crowded.join(asked, "key").groupBy("key", "doc", "groups").agg(_furthest())
                      .select("key", "doc", "groups", F.explode("_at").alias("at")), "offers")
    asked = stored(offering.groupBy("key", "groups").agg(F.ceil(F.count("*") / BLOCK_WINDOWS).cast("int").alias("blocks")), "open-keys")
    salt = F.xxhash64("doc", "at")
    offers = (offering.join(asked.drop("groups"), "key").withColumn("block", F.pmod(salt, F.col("blocks")).cast("int"))
              .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .select("key", "block", "group", F.col("doc").alias("a"), F.col("at").alias("a_at")))
    asks = (asking.join(asked, "key").withColumn("group", F.pmod(salt, F.col("groups")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", "block", "group", F.col("doc").alias("b"), F.col("at").alias("b_at")))
    return _by_pair(_without(offers.join(asks, ["key", "block", "group"]), done))


def common_passages(a: np.ndarray, b: np.ndarray, diagonals: list[tuple[int, int, int]], offset: int = 0,
                    more_before: bool = False, more_after: bool = False) -> list[tuple[int, int, int, int, float]] | None:
    """(start in a, end in a, start in b, end in b, similarity), in shingles,
    ends exclusive, of the verified passages near the diagonals. A diagonal
    comes with the first and last position in a where windows met; the texts
    are compared around them, and further as long as shared shingles reach the
    end of what was compared. ``a`` may be a part of its text from shingle
    ``offset`` on; None says that more of it is needed."""
    found: list[tuple] = []
    for d, lo, hi in diagonals:
        low, lo, hi = d * _SHIFT + offset, lo - offset, hi - offset
        high = low + _SHIFT
        shifts = np.array(sorted(range(low - _SHIFT, high + _SHIFT), key=lambda s: (abs(s - (low + high) // 2), -s)))
        margin = MARGIN
        while True:
            x, z = max(0, lo - margin), min(len(a), hi + margin + 1)
            at, first, last = _nearest(a, b, x, max(x, z), shifts)
            hits = np.flatnonzero(at >= 0)
            left = len(hits) > 0 and hits[0] <= _GAP
            right = len(hits) > 0 and hits[-1] >= z - x - 1 - _GAP
            if (left and x == 0 and more_before) or (right and z == len(a) and more_after):
                return None
            if not (left and x > 0) and not (right and z < len(a)):
                if len(hits):
                    _grow(a, b, hits + x, *(np.concatenate([np.full(x, -1), p]) for p in (at, first, last)), found)
                break
            margin *= 4
    return _apart([(i0 + offset, i1 + offset, j0, j1, s) for i0, i1, j0, j1, s in found])


def _nearest(a: np.ndarray, b: np.ndarray, x: int, z: int, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where in b the shingles x to z of a occur at one of the shifts (all
    numbers of a range, the preferred ones first); -1 if at none. Then the
    first and the last such place."""
    low, width = int(shifts.min()), len(shifts)
    begin, need = x + low, z - x + width - 1
    p, q = max(0, begin), min(len(b), begin + need)
    if z <= x or q <= p:
        return (np.full(z - x, -1, dtype=np.int64),) * 3
    near, inside = np.zeros(need, dtype=b.dtype), np.zeros(need, dtype=bool)
    near[p - begin:q - begin], inside[p - begin:q - begin] = b[p:q], True
    same = as_strided(near, (z - x, width), near.strides * 2) == a[x:z, None]
    if q - p < need:
        same &= as_strided(inside, (z - x, width), inside.strides * 2)
    rows = np.arange(z - x)
    best = shifts[same[:, shifts - low].argmax(axis=1)]
    hit = same[rows, best - low]
    return tuple(np.where(hit, rows + x + shift, -1) for shift in (best, low + same.argmax(axis=1), low + width - 1 - same[:, ::-1].argmax(axis=1)))


def _grow(a, b, hits, at, first, last, found):
    """Cuts the shared positions where they lie far apart, and a piece that is
    not similar enough at its widest gap. Where a shingle repeats, b's part may
    begin earlier and end later than the preferred places."""
    stack = [np.asarray(p) for p in np.split(hits, np.flatnonzero(np.diff(hits) > _GAP) + 1)]
    while stack:
        piece = stack.pop()
        i0, i1 = int(piece[0]), int(piece[-1]) + 1
        if i1 - i0 < _WIDTH - 2 * _SHIFT:
            continue
        near = int(at[piece].min()), int(at[piece].max()) + 1
        far = min(near[0], int(first[i0])), max(near[1], int(last[i1 - 1]) + 1)
        for j0, j1 in (near, far) if far != near else (near,):
            if min(i1 - i0, j1 - j0) >= _WIDTH:
                x, y = np.unique(a[i0:i1]), np.unique(b[j0:j1])
                both = len(np.intersect1d(x, y, assume_unique=True))
                s = both / (len(x) + len(y) - both)
                if s >= SIMILARITY:
                    found.append((i0, i1, j0, j1, s))
                    break
        else:
            gaps = np.diff(piece)
            if len(gaps) and gaps.max() > 1:
                cut = int(gaps.argmax()) + 1
                stack += [piece[:cut], piece[cut:]]


def _apart(found: list[tuple]) -> list[tuple]:
    """The longest passages first, without those that lie within another."""
    kept: list[tuple] = []
    for p in sorted(found, key=lambda p: (-(p[3] - p[2]), p)):
        if not any(q[2] <= p[2] and p[3] <= q[3] and q[0] <= p[0] and p[1] <= q[1] for q in kept):
            kept.append(p)
    return sorted(kept, key=lambda p: (p[2], p))


_FOUND = "doc_id long, start_word long, n_words long, source_id long, source_start long, source_words long, similarity double"


_PARTS = "a long, b long, diagonals array<struct<diagonal:int,lo:int,hi:int>>, offset int, more boolean, part string"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage of a document that an earlier one (by id) holds
    too: doc_id, start_word, n_words, source_id, source_start, source_words,
    similarity."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    crowded = stored(crowded_windows(docs), "windows")
    pairs = stored(candidate_pairs(crowded), "pairs")
    found, cuts = _verified(pairs, docs)
    found, done = stored(found, "found"), _diagonals(pairs)
    asking = stored(open_windows(crowded, found), "open")
    pairs = stored(open_pairs(crowded, asking, done), "pairs")
    more, more_cuts = _verified(pairs, docs)
    more = more.join(_places(found), _within(), "left_anti")
    return _in_whole_texts(found.unionByName(more), cuts.unionByName(more_cuts).dropDuplicates(["doc_id"]))


def _diagonals(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", F.explode("diagonals").alias("_d")).select("a", "b", "_d.diagonal")


def _places(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc_id").alias("_doc"), F.col("source_id").alias("_source"), F.col("start_word").alias("_start"), F.col("n_words").alias("_n"),
                        F.col("source_start").alias("_at"), F.col("source_words").alias("_words"))


def _within() -> Column:
    return ((F.col("doc_id") == F.col("_doc")) & (F.col("source_id") == F.col("_source"))
            & (F.col("start_word") >= F.col("_start")) & (F.col("start_word") + F.col("n_words") <= F.col("_start") + F.col("_n"))
            & (F.col("source_start") >= F.col("_at")) & (F.col("source_start") + F.col("source_words") <= F.col("_at") + F.col("_words")))


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The passages of the pairs (a, b, diagonals), verified on the texts. Of
    a's text the part around the windows is sent to b's; the few pairs whose
    passages reach further are verified again with more of it."""
    shortened = stored(_one_row(docs, _ids(pairs)).mapInArrow(_shorten, _SHORT), "texts")
    texts, cuts = shortened.select("doc_id", "text"), shortened.where(F.size("cuts") > 0).select("doc_id", "cuts")
    found, margin = None, MARGIN
    while True:
        parts = pairs.join(texts.toDF("a", "text"), "a").select("a", "b", "diagonals", "text").mapInArrow(_cut_parts(margin), _PARTS)
        rows = stored(parts.join(texts.toDF("b", "text"), "b").select("a", "b", "diagonals", "offset", "more", "part", "text")
                      .mapInArrow(_verify_parts, f"{_FOUND}, open boolean"), "verified")
        done = rows.where("not open").drop("open")
        found = done if found is None else found.unionByName(done)
        again = rows.where("open").select(F.col("source_id").alias("a"), F.col("doc_id").alias("b"))
        if again.isEmpty():
            return found, cuts
        pairs, margin = stored(pairs.join(again, ["a", "b"], "left_semi"), "again"), 16 * margin
        texts = texts.join(_ids(pairs), "doc_id", "left_semi")


def _small(ids: DataFrame) -> DataFrame:
    """``ids``, sent to all executors if there are few, so that the texts they
    are looked up for stay where they are."""
    ids = stored(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _ids(pairs: DataFrame) -> DataFrame:
    return _small(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())


def _one_row(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents ``ids``, the least text of each. Only
    the texts of ids that repeat are shuffled."""
    own = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    repeated = _small(own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    least = own.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return own.join(repeated, "doc_id", "left_anti").unionByName(least)


_SHORT = "doc_id long, text string, cuts array<struct<at:int,n:int>>"


@thrifty
def _shorten(batches):
    """Texts (doc_id, text) without the words that ``_without_long_runs``
    leaves out; with the number of words left out before the word ``at``."""
    for batch in batches:
        texts, cuts = batch.column(1).to_pylist(), [[] for _ in range(batch.num_rows)]
        for chunk in word_chunks(batch.column(1)):
            stay = _without_long_runs(chunk.hashes, chunk.bounds)
            if len(stay) == len(chunk.hashes):
                continue
            edges = np.searchsorted(stay, chunk.bounds)
            for r in np.flatnonzero(np.diff(edges) < np.diff(chunk.bounds)).tolist():
                words = stay[edges[r]:edges[r + 1]]
                raw, out, done = texts[chunk.first + r].encode(), [], 0
                for k in np.flatnonzero(np.diff(words) > 1).tolist():
                    left_out, after = int(words[k]) + 1, int(words[k + 1])
                    out.append(raw[done:int(chunk.starts[left_out])])
                    done = int(chunk.starts[after])
                    cuts[chunk.first + r].append({"at": k + 1, "n": after - left_out})
                texts[chunk.first + r] = b"".join([*out, raw[done:]]).decode()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(cuts, pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))],
                                         names=["doc_id", "text", "cuts"])


def _in_whole_texts(found: DataFrame, cuts: DataFrame) -> DataFrame:
    """Passages of shortened texts at their places in the whole ones."""
    def place(word: Column) -> Column:
        before = F.filter("_cuts", lambda c: c["at"] <= word)
        return word + F.coalesce(F.aggregate(before, F.lit(0).cast("long"), lambda n, c: n + c["n"]), F.lit(0).cast("long"))

    columns = found.columns
    for doc, start, n in (("doc_id", "start_word", "n_words"), ("source_id", "source_start", "source_words")):
        first, last = place(F.col(start)), place(F.col(start) + F.col(n) - 1)
        found = (found.join(cuts.select(F.col("doc_id").alias("_doc"), F.col("cuts").alias("_cuts")), F.col(doc) == F.col("_doc"), "left")
                 .withColumn("_first", first).withColumn(n, last - F.col("_first") + 1).withColumn(start, F.col("_first")).drop("_doc", "_cuts", "_first"))
    return found.select(*columns)


def _cut_parts(margin: int):
    """Replaces a's text by the words around the windows that met."""
    @thrifty
    def cut(batches):
        for batch in batches:
            offsets, more, parts = [], [], []
            texts = batch.column("text")
            for spans, text, (starts, ends) in zip(batch.column("diagonals").to_pylist(), texts, _word_rows(texts)):
                x = max(0, min(q["lo"] for q in spans) - margin)
                z = min(len(starts), max(q["hi"] for q in spans) + margin + SHINGLE_WORDS)
                offsets.append(x)
                more.append(z < len(starts))
                parts.append(text.as_buffer().to_pybytes()[starts[x]:ends[z - 1]] if z > x else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), batch.column("diagonals"), pa.array(offsets, pa.int32()),
                 pa.array(more, pa.bool_()), pa.array(parts, pa.binary()).cast(pa.string())],
                names=["a", "b", "diagonals", "offset", "more", "part"])

    return cut


@thrifty
def _verify_parts(batches):
    names = [f.split()[0] for f in _FOUND.split(", ")] + ["open"]
    kinds = [pa.int64()] * 6 + [pa.float64(), pa.bool_()]
    for batch in batches:
        for columns in _verified_rows(batch):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _verified_rows(batch):
    """The columns of ``_FOUND`` and ``open`` for a batch of pairs, a chunk of
    their parts at a time. Equal texts of b that follow each other are read once."""
    a, b, offset, more = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "offset", "more"))
    offset, more = offset.astype(np.int64), more.astype(bool)
    ends = np.append(0, np.cumsum(pa.compute.list_value_length(batch.column("diagonals")).to_numpy(zero_copy_only=False)))
    spans = batch.column("diagonals").flatten()
    spans = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in spans.flatten()]
    others = _shingle_rows(batch.column("text"))
    for chunk in word_chunks(batch.column("part")):
        rows = slice(chunk.first, chunk.first + chunk.rows)
        parts, bounds = _chunk_shingles(chunk.hashes, chunk.bounds)
        texts = [next(others) for _ in range(chunk.rows)]
        used = slice(ends[rows.start], ends[rows.stop])
        owner = np.repeat(np.arange(chunk.rows), np.diff(ends[rows.start:rows.stop + 1]))
        found, open_ = passages_of_pairs(parts, bounds, texts, (owner, *(c[used] for c in spans)), offset[rows], more[rows])
        row, i0, i1, j0, j1, s = found
        n, k = np.flatnonzero(open_) + rows.start, row + rows.start
        if len(n) + len(k):
            none = np.zeros(len(n), dtype=np.int64)
            yield tuple(np.concatenate(c) for c in (
                (b[k], b[n]), (j0, none), (j1 - j0 + SHINGLE_WORDS - 1, none), (a[k], a[n]), (i0, none), (i1 - i0 + SHINGLE_WORDS - 1, none),
                (s, none.astype(float)), (np.zeros(len(k), dtype=bool), np.ones(len(n), dtype=bool))))


def _chunk_shingles(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds) of several texts laid end to end, without the
    shingles that reach into the next text."""
    shingles = shingle_hashes(words)
    counts = np.maximum(np.diff(edges) - SHINGLE_WORDS + 1, 0)
    if len(shingles):
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:len(shingles)]
        shingles = shingles[np.arange(len(shingles)) + SHINGLE_WORDS <= edges[row + 1]]
    return shingles, np.concatenate([[0], np.cumsum(counts)])


def _places_in(texts: list[np.ndarray], shingles: np.ndarray, bounds: np.ndarray):
    """Of the shingles of several parts laid end to end, each with a text:
    the place in the text (-1 if there is none); whether a part has a shingle
    that its text holds twice; per row the text's length up to which each place
    has the latest earlier place of a shingle seen twice (None if none is)."""
    at, twice, repeats = np.full(len(shingles), -1, dtype=np.int64), np.zeros(len(texts), dtype=bool), [None] * len(texts)
    k = 0
    while k < len(texts):
        e = k + 1
        while e < len(texts) and texts[e] is texts[k]:
            e += 1
        text, own = texts[k], slice(bounds[k], bounds[e])
        if len(text) and own.stop > own.start:
            order = np.argsort(text, kind="stable")
            ranked = text[order]
            asked = shingles[own]
            rank = np.minimum(np.searchsorted(ranked, asked), len(ranked) - 1)
            hit = ranked[rank] == asked
            at[own] = np.where(hit, order[rank], -1)
            same = ranked[1:] == ranked[:-1]
            if same.any():
                again = np.append(same, False)[rank] & hit
                twice[k:e] = np.diff(np.append(0, np.cumsum(again))[bounds[k:e + 1] - own.start]) > 0
                repeats[k:e] = [_repeats(order, same)] * (e - k)
        k = e
    return at, twice, repeats


def _repeats(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Up to each place, the latest place whose value comes again by then; from
    the stable order of the values and where neighbours in it are equal."""
    before = np.full(len(order), -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    return np.maximum.accumulate(before)


def _repeats_in_parts(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``_repeats`` of parts laid end to end, counted from their starts."""
    out = np.full(len(shingles), -1, dtype=np.int64)
    rows = len(bounds) - 1
    bits = np.uint64(max(1, int(rows).bit_length()))
    row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(bounds))
    keys = np.sort((shingles >> bits) | (row << (np.uint64(64) - bits)))
    for k in np.unique(keys[1:][keys[1:] == keys[:-1]] >> (np.uint64(64) - bits)).tolist():   # few
        own = slice(bounds[k], bounds[k + 1])
        order = np.argsort(shingles[own], kind="stable")
        ranked = shingles[own][order]
        out[own] = _repeats(order, ranked[1:] == ranked[:-1])
    return out


_ROW = 32                                       # bits of a place, below the number of a row


def passages_of_pairs(parts: np.ndarray, bounds: np.ndarray, texts: list[np.ndarray], spans: tuple, offset: np.ndarray,
                      more: np.ndarray) -> tuple[tuple, np.ndarray]:
    """What ``common_passages`` gives for several pairs at once: (row, start in
    a, end in a, start in b, end in b, similarity), and of each row whether more
    of a is needed. Part k is ``parts[bounds[k]:bounds[k + 1]]``, its text
    ``texts[k]``, its diagonals (row, diagonal, first, last) stand in ``spans``.

    Where each shared shingle has one place in b, the places near a diagonal
    rise, and no other shared shingle lies in between, the similarity of a piece
    follows from its ends. The pieces that ``_grow`` looks at are then the nodes of
    the Cartesian tree over the gaps, and the passages its topmost similar
    ones. Rows where this does not hold are left to ``common_passages``."""
    rows, size = len(texts), np.diff(bounds)
    at, twice, repeats = _places_in(texts, parts, bounds)
    row_of, diagonal, lo, hi = spans
    low, lo, hi = diagonal * _SHIFT + offset[row_of], lo - offset[row_of], hi - offset[row_of]

    shared = np.flatnonzero(at >= 0)
    begins = np.searchsorted(shared, bounds)
    n = np.diff(begins)[row_of]
    span = np.repeat(np.arange(len(row_of)), n)
    pick = shared[gather_runs(np.arange(len(shared)), begins[row_of], n)] if len(shared) else shared
    i, j = pick - bounds[row_of[span]], at[pick]
    near = (j - i >= low[span] - _SHIFT) & (j - i < low[span] + 2 * _SHIFT)
    other_key, other_j = (span[~near] << _ROW) + i[~near], j[~near]
    span, i, j = span[near], i[near], j[near]
    key = (span << _ROW) + i

    open_ = np.zeros(rows, dtype=bool)
    p, q = np.zeros(len(row_of), dtype=np.int64), np.zeros(len(row_of), dtype=np.int64)
    active, margin = np.arange(len(row_of)), MARGIN
    while len(active):
        length = size[row_of[active]]
        x, z = np.maximum(lo[active] - margin, 0), np.minimum(hi[active] + margin + 1, length)
        z = np.maximum(x, z)
        p[active], q[active] = np.searchsorted(key, (active << _ROW) + x), np.searchsorted(key, (active << _ROW) + z)
        some = q[active] > p[active]
        left, right = some.copy(), some.copy()
        left[some] = i[p[active[some]]] - x[some] <= _GAP
        right[some] = i[q[active[some]] - 1] >= z[some] - 1 - _GAP
        needs = (left & (x == 0) & (offset[row_of[active]] > 0)) | (right & (z == length) & more[row_of[active]])
        open_[row_of[active[needs]]] = True
        on = ~needs & ((left & (x > 0)) | (right & (z < length)))
        active, margin = active[on], margin * 4

    kept = gather_runs(np.arange(len(key)), p, np.maximum(q - p, 0)) if len(key) else np.zeros(0, dtype=np.int64)
    key, i, j, span = key[kept], i[kept], j[kept], span[kept]
    open_ &= ~twice
    slow = twice.copy()
    found = _topmost(key, i, j, row_of[span] if len(span) else span, bounds, other_key, other_j, _repeats_in_parts(parts, bounds), repeats, slow)
    out = []
    row = found[0]
    fine = ~(slow | open_)[row]
    row, *rest = (c[fine] for c in found)
    several = np.bincount(row, minlength=rows)[row] > 1
    out.append((row[~several], *(c[~several] for c in rest)))
    extra: dict[int, list] = {}
    for r, *passage in zip(row[several].tolist(), *(c[several].tolist() for c in rest)):
        extra.setdefault(r, []).append(tuple(passage))
    by_hand = [(r, passage) for r, passages in extra.items() for passage in _apart(passages)]
    first = np.searchsorted(row_of, np.arange(rows + 1))
    for r in np.flatnonzero(slow & ~open_).tolist():
        own = slice(first[r], first[r + 1])
        passages = common_passages(parts[bounds[r]:bounds[r + 1]], texts[r], list(zip(diagonal[own].tolist(), (lo[own] + offset[r]).tolist(), (hi[own] + offset[r]).tolist())),
                                   int(offset[r]), bool(offset[r] > 0), bool(more[r]))
        if passages is None:
            open_[r] = True
        by_hand += [(r, (i0 - int(offset[r]), i1 - int(offset[r]), j0, j1, s)) for i0, i1, j0, j1, s in passages or []]
    if by_hand:
        columns = zip(*((r, *passage) for r, passage in by_hand))
        out.append(tuple(np.array(c, dtype=t) for c, t in zip(columns, [np.int64] * 5 + [np.float64])))
    row, i0, i1, j0, j1, s = (np.concatenate(c) for c in zip(*out))
    return (row, i0 + offset[row], i1 + offset[row], j0, j1, s), open_


def _topmost(key, i, j, row, bounds, other_key, other_j, part_repeats, repeats, slow):
    """(row, i0, i1, j0, j1, similarity) of the topmost similar pieces of the
    shared places (i, j) of the spans, which come in the order of ``key``. Marks
    in ``slow`` the rows of which the ends of a piece do not say enough."""
    if not len(key):
        return (np.zeros(0, dtype=np.int64),) * 5 + (np.zeros(0),)
    step = np.diff(key)
    starts = np.append(0, np.flatnonzero(step != 1) + 1)                    # runs of consecutive shingles
    stops = np.append(starts[1:], len(key)) - 1
    gap = step[stops[:-1]]
    apart = gap > _GAP                                                      # another span, too
    # pieces before the first cut
    u, v = np.append(0, np.flatnonzero(apart) + 1), np.append(np.flatnonzero(apart), len(starts) - 1)
    f, t = starts[u], stops[v]
    wide = i[t] - i[f] + 1 >= _WIDTH
    falls = np.append(0, np.cumsum(np.append(j[1:] <= j[:-1], False)))
    bad = falls[t] > falls[f]
    within = np.searchsorted(key[f], other_key, side="right") - 1
    strays = (within >= 0) & (other_key <= key[t[within]]) & (other_j >= j[f[within]]) & (other_j <= j[t[within]])
    bad[within[strays]] = True
    bad |= part_repeats[bounds[row[f]] + i[t]] >= i[f]
    for k in np.flatnonzero(wide & ~bad).tolist() if any(r is not None for r in repeats) else []:
        r = repeats[row[f[k]]]
        bad[k] = r is not None and r[j[t[k]]] >= j[f[k]]
    slow[row[f[wide & bad]]] = True

    # nodes of the tree over the gaps: the leftmost widest gap is cut first
    inner = np.flatnonzero(~apart)
    height = -np.where(apart, len(key) + _GAP + 1, gap)
    one = np.zeros(len(gap), dtype=np.int64)
    before = _smaller_before(height, one, strict=False)
    after = len(gap) - 1 - _smaller_before(height[::-1], one, strict=True)[::-1]
    u, v = np.append(before[inner] + 1, np.arange(len(starts))), np.append(after[inner], np.arange(len(starts)))
    f, t = starts[u], stops[v]
    x, y, both = i[t] - i[f] + 1, j[t] - j[f] + 1, t - f + 1
    fits = (x >= _WIDTH) & (y >= _WIDTH)
    u, v, f, t, x, y, both = (c[fits] for c in (u, v, f, t, x, y, both))
    s = both / (x + y - both)
    like = s >= SIMILARITY
    u, v, f, t, s = (c[like] for c in (u, v, f, t, s))
    order = np.lexsort((-v, u))
    u, v, f, t, s = (c[order] for c in (u, v, f, t, s))
    top = np.append(True, v[1:] > np.maximum.accumulate(v)[:-1]) if len(v) else np.zeros(0, dtype=bool)
    f, t, s = f[top], t[top], s[top]
    return row[f], i[f], i[t] + 1, j[f], j[t] + 1, s


def _by_row(column: pa.Array, of_distinct):
    """What ``of_distinct`` gives for every row of a text column; of equal
    texts that follow each other (a join sorts them) only the first is read."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    new = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        new[1:] = pa.compute.fill_null(pa.compute.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
    distinct, now = of_distinct(column.filter(pa.array(new))), None
    for fresh in new.tolist():
        if fresh:
            now = next(distinct)
        yield now


def _shingle_rows(column: pa.Array):
    def read(texts):
        for chunk in word_chunks(texts):
            for p, q in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                yield shingle_hashes(chunk.hashes[p:q])

    return _by_row(column, read)


def _word_rows(column: pa.Array):
    """(starts, ends) of the words of every row, in bytes."""
    def read(texts):
        for chunk in word_chunks(texts):
            for p, q in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                yield chunk.starts[p:q], chunk.ends[p:q]

    return _by_row(column, read)


def without_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the found passages cut out of the later documents; all
    columns and rows stay."""
    cuts = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "n_words")).alias("_cuts"))
    cuts = cuts.withColumnRenamed("doc_id", "_cut_id")
    rows = docs.join(cuts, F.col(id_col) == F.col("_cut_id"), "left").drop("_cut_id")
    names, at = docs.columns, docs.columns.index(text_col)

    @thrifty
    def cut(batches):
        for batch in batches:
            new = batch.column(at).to_pylist()
            spans = batch.column(len(names)).to_pylist()
            touched = [k for k, s in enumerate(spans) if s and new[k]]
            column = pa.array([new[k] for k in touched], pa.string())
            for chunk in word_chunks(column):
                for r in range(chunk.rows):
                    k = touched[chunk.first + r]
                    p, raw = int(chunk.bounds[r]), new[k].encode()
                    keep, done = [], 0
                    for s in sorted(spans[k], key=lambda s: (s["start_word"], s["n_words"])):
                        first, last = p + s["start_word"], p + s["start_word"] + s["n_words"] - 1
                        keep.append(raw[done:max(done, int(chunk.starts[first]))])
                        done = max(done, int(chunk.ends[last]))
                    new[k] = (b"".join(keep) + raw[done:]).decode()
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, docs.schema)
