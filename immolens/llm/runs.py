"""Operator 11: periodic runs of words, found in grammar-compressed texts.

A run is a stretch of words with smallest period q and a length of at least
max(12, 2q) that no neighbouring word extends. Per batch of texts:

1. Re-Pair compresses the word ids to a grammar (``grammar``).
2. A run lies within the lowest nonterminal that holds all of it and crosses
   that nonterminal's boundary. So the runs that cross the boundary of a
   nonterminal's two halves are computed once per nonterminal, at one of its
   positions: words that agree over a distance q do so for at least six words
   in a row, so the periods to try come from the other places of the six-word
   sequences around the boundary; each is extended to both sides.
3. The results are translated to all positions of the derivation, and the
   pieces of one period that overlap by a period are merged.

A text in which no six words occur twice holds no run (a run's first
``length - period >= 6`` words come again one period later) and needs no
grammar. Everything is exact: word ids stand for whole words (64-bit hashes of
them), and sequences are compared by exact names, not by fingerprints.

Results that are defined here: a null or empty text has no words, no runs and
the empty collapsed text; repeated rows give repeated results; other columns
stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.grammar import SEPARATOR, Names, build_grammar, derivation
from immolens.llm.hashing import mix64, run_hashes
from immolens.llm.memory import give_back
from immolens.llm.words import text_buffer

LEAST = 12                      # words of the shortest run
SAME = LEAST // 2               # words that agree over one period, at least
CHUNK_BYTES = 1 << 20           # texts looked at together (a longer one by itself)
MAX_PAIRS = 1 << 21             # periods tried together

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN_FIELDS = ["start", "length", "period"]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _periods_at(names: Names, sixes: np.ndarray, s: np.ndarray, b: np.ndarray, e: np.ndarray):
    """(nonterminal, left or right, period) to try for the boundaries ``b``
    inside ``s .. e``. Left: the word at b equals the one a period before; right: the
    word before b equals the one a period after."""
    n = len(sixes)
    order = np.argsort(sixes, kind="stable")
    sorted_keys = sixes[order] * n + order
    shared = np.zeros(n, dtype=bool)
    equal = sixes[order[1:]] == sixes[order[:-1]]
    shared[order[1:][equal]] = shared[order[:-1][equal]] = True
    tries = []
    for left in (True, False):
        for d in range(SAME):
            x = b - d if left else b - 1 - d
            fits = np.flatnonzero((x >= s) & (x + SAME <= e))
            fits = fits[shared[x[fits]]]
            lo, hi = (s[fits], x[fits]) if left else (x[fits] + 1, e[fits] - SAME + 1)
            group = sixes[x[fits]] * n
            i = np.searchsorted(sorted_keys, group + lo)
            j = np.searchsorted(sorted_keys, group + hi)
            some = j > i
            tries.append((fits[some], x[fits[some]], i[some], j[some], np.full(int(some.sum()), left)))
    which, x, i, j, left = (np.concatenate(c) for c in zip(*tries))
    by = np.argsort(which, kind="stable")
    which, x, i, j, left = which[by], x[by], i[by], j[by], left[by]
    upto = np.concatenate([[0], np.cumsum(j - i)])
    a = 0
    while a < len(which):                                   # bounded blocks, cut between nonterminals
        z = int(np.searchsorted(upto, upto[a] + MAX_PAIRS, side="right")) - 1
        z = int(np.searchsorted(which, which[min(max(z, a + 1), len(which)) - 1], side="right"))
        size = (j - i)[a:z]
        other = order[np.arange(upto[z] - upto[a]) + np.repeat(i[a:z] - (upto[a:z] - upto[a]), size)]
        period = np.abs(np.repeat(x[a:z], size) - other)
        key = np.unique((np.repeat(which[a:z], size) * 2 + np.repeat(left[a:z], size)) * (n + SAME) + period)
        yield key // (2 * (n + SAME)), key // (n + SAME) % 2 == 1, key % (n + SAME)
        a = z


def _unique_rows(*columns: np.ndarray) -> np.ndarray:
    """Of rows that agree in all columns but the last, the positions of those
    with the least value there."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns[:-1]], axis=0)
    return order[new]


def runs_of(words: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the texts in ``words`` (ids with a
    separator after each text), by start, then period."""
    none = np.zeros(0, dtype=np.int64)
    names = Names(words)
    sixes = names.sixes()
    if not len(sixes):
        return none, none, none
    grammar = build_grammar(words, terminals)
    symbols, places = derivation(grammar, LEAST)
    if not len(symbols):
        return none, none, none
    once, first, occurrence = np.unique(symbols, return_index=True, return_inverse=True)
    s = places[first]
    b = s + grammar.length[grammar.left[once - grammar.terminals]]
    e = s + grammar.length[once]
    pieces = [(none, none, none, none)]
    for which, left, q in _periods_at(names, sixes, s, b, e):
        k = b[which] - np.where(left, q, 1)                 # the word here equals the one a period on
        right = names.common(k, k + q, e[which] - k - q)
        before = names.common(k - 1, k + q - 1, k - s[which], back=True)
        same = before + right
        ok = (right > 0) & (same >= q) & (same + q >= LEAST)
        start = (k - before - s[which])[ok]
        pieces.append((which[ok], start, start + (same + q)[ok], q[ok]))
    which, start, end, q = (np.concatenate(c) for c in zip(*pieces))
    one = _unique_rows(which, start, end, q)                # multiples of a period give the same stretch
    which, start, end, q = which[one], start[one], end[one], q[one]
    # to all positions: the pieces of a nonterminal lie together
    count = np.bincount(which, minlength=len(once))
    begin = np.cumsum(count) - count
    size = count[occurrence]
    index = np.arange(int(size.sum())) + np.repeat(begin[occurrence] - (np.cumsum(size) - size), size)
    base = np.repeat(places, size)
    return merged(base + start[index], base + end[index], q[index])


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches: pieces of one period that overlap by a period or
    more are one; of equal stretches the least period counts."""
    if not len(start):
        return start, end, period
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    far = int(end.max()) + 1
    group = np.concatenate([[0], np.cumsum(period[1:] != period[:-1])])
    reach = np.maximum.accumulate(end + group * far) - group * far
    new = np.ones(len(start), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - period[1:])
    heads = np.flatnonzero(new)
    start, period, end = start[heads], period[heads], reach[np.append(heads[1:], len(new)) - 1]
    one = _unique_rows(start, end, period)
    start, end, period = start[one], end[one], period[one]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _repeating(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold six words twice."""
    rows, n = len(bounds) - 1, len(hashes) - SAME + 1
    found = np.zeros(rows, dtype=bool)
    if n <= 0:
        return found
    row = np.repeat(np.arange(rows), np.diff(bounds))
    six = mix64(row[:n].astype(np.uint64))
    for d in range(SAME):
        six = mix64(six + hashes[d:d + n])
    inside = np.flatnonzero(row[:n] == row[SAME - 1:])
    order = inside[np.argsort(six[inside], kind="stable")]
    found[row[order[1:][six[order[1:]] == six[order[:-1]]]]] = True
    return found


def _chunk_result(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
    n_rows = len(offsets) - 1
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    solid = ~_BLANK[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:len(data)]
    stops[:-1] &= ~solid[1:] | edge[1:len(data)]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = run_hashes(data, starts, ends)

    # texts that repeat themselves, one after the other
    rows = np.flatnonzero(_repeating(hashes, bounds))
    size = bounds[rows + 1] - bounds[rows]
    shift = np.cumsum(size + 1) - (size + 1)                # of the texts in the joined array
    ids = np.full(int((size + 1).sum()), SEPARATOR, dtype=np.int64)
    inside = np.ones(len(ids), dtype=bool)
    inside[shift + size] = False
    word = np.arange(int(size.sum())) + np.repeat(bounds[rows] - (np.cumsum(size) - size), size)
    vocabulary, ids[inside] = np.unique(hashes[word], return_inverse=True)
    start, end, period = runs_of(ids, len(vocabulary))
    owner = np.searchsorted(shift, start, side="right") - 1

    # words that repeat what stands one period before them
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    to_word = bounds[rows[owner]] - shift[owner]
    np.add.at(change, start + period + to_word, 1)
    np.add.at(change, end + to_word, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)

    counts = np.bincount(rows[owner], minlength=n_rows)
    fields = [pa.array(x) for x in (start - shift[owner], end - start, period)]
    found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                                     pa.StructArray.from_arrays(fields, names=_RUN_FIELDS))
    return found, _joined(data, starts[kept], ends[kept], np.searchsorted(kept, bounds))


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The words of every row joined by single spaces."""
    space = np.ones(len(starts), dtype=np.int64)
    space[bounds[:-1][bounds[:-1] < bounds[1:]]] = 0        # a row's first word has none before it
    length = ends - starts
    last = np.cumsum(length + space)
    out = np.full(int(last[-1]) if len(last) else 0, 32, dtype=np.uint8)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(last - length, length) + inside] = data[np.repeat(starts, length) + inside]
    offsets = np.concatenate([[0], last])[bounds].astype(np.int32)
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), pa.py_buffer(out))


def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    try:
        for column in batches:
            data, offsets = text_buffer(column)
            parts, a, rows = [], 0, len(offsets) - 1
            while a < rows:
                b = int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1
                b = min(max(b, a + 1), rows)
                parts.append(_chunk_result(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                a = b
            runs, texts = zip(*parts) if parts else ([pa.array([], pa.list_(pa.struct(
                [(f, pa.int64()) for f in _RUN_FIELDS])))], [pa.array([], pa.string())])
            yield pa.StructArray.from_arrays([pa.concat_arrays(runs), pa.concat_arrays(texts)], names=["runs", "collapsed"])
    finally:
        give_back()


def periodic_runs(text: Column | str) -> Column:
    """A struct per text: ``runs`` (start, length and period in words, by
    start, then period) and ``collapsed``, the text's words without those that
    a run contains after its first period, joined by one space."""
    return F.arrow_udf(_find, f"struct<runs:{RUNS},collapsed:string>")(text)


def with_periodic_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs",
                       collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` with both results; columns of those names are replaced."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (runs_col, collapsed_col)]
    found = docs.select(*keep, periodic_runs(F.col(f"`{text_col}`")).alias("_found"))
    return found.select(*keep, F.col("_found.runs").alias(runs_col), F.col("_found.collapsed").alias(collapsed_col))


def planted_periods(doc_id: Column, text: Column) -> Column:
    """The query's texts: where crc32(id) is divisible by ten, the words from
    place a on repeat p of them. Rows without id stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / F.lit(10))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"),
                  F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(text)


def runs_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: the number of runs, the greatest one, and checksums
    of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start.alias("s"), r.period.alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"),
                                                               r.period.cast("string")), F.lit("\n")))
    one = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), best.alias("_b"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("_b.l"), F.col("_b.p")
    return one.select(id_col, "n_runs", F.col("_b.s").alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
