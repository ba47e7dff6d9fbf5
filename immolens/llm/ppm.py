"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ``ORDER`` = 4 bytes, with the
counts of the byte that follows, pretrained on the training documents. A text
is its UTF-8 bytes, behind four start symbols and before an end symbol. A byte
is coded in its longest context that was seen; if it never followed there, the
escape is coded (method C: as often as the context has distinct followers) and
the next shorter context is tried, without the symbols that were already ruled
out. At the bottom all remaining symbols are equally likely. A document's
score is the log10 probability of its bytes and the end.

The base score beside it is a word unigram model with add-one smoothing.

How it runs:
1. Every task counts the 5-byte runs and the words of its rows; sums by key
   give the trie (one row per context and follower) and the word counts.
2. Runs with the same two bytes before the last hold all that the code lengths
   in question need, but for the contexts of at most one byte: those have at most
   256 x 256 counts, which are sent to all tasks. So one grouping gives the
   code length of every run that occurs.
3. Documents are dealt into chunks of about ``CHUNK_BYTES``. Each chunk asks
   for the words and runs it holds, a join answers, and each chunk is scored
   with its own answers. Nothing that grows with the corpus is broadcast.

Cases: a null or empty text is its end alone. A row without id is a training
row. Repeated rows all count; rows that repeat an id and text more than
``folded`` allows are scored once, as they score alike, and listed as often as
they occur, so that no chunk holds them all. Texts of any length are
scored whole. Without training rows every byte is equally likely and
``train_tokens`` is 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.copies import folded, unfolded
from immolens.llm.memory import thrifty
from immolens.llm.tables import stored
from immolens.llm.words import CHUNK_BYTES as TEXT_STEP
from immolens.llm.words import _chunk, text_buffer

ORDER = 4
START, END = 0xFE, 0xFF       # bytes that UTF-8 never uses
SYMBOLS = 255                 # all bytes but START
CHUNK_BYTES = 16 << 20         # a larger chunk asks for fewer keys in all
MAX_PARTITIONS = 20_000
_FLUSH = 1 << 21


def _pieces(column: pa.Array):
    """(first row, word chunk, runs, row of each run) for bounded parts of a
    text column. Runs are ``ORDER`` + 1 bytes, the last one being the coded
    symbol, as one integer."""
    data, offsets = text_buffer(column)
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + TEXT_STEP, side="right")) - 1
        b = min(max(b, a + 1), rows)
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        n = b - a
        row = np.repeat(np.arange(n), np.diff(at))
        extra = ORDER + 1
        framed = np.full(len(part) + extra * n, START, dtype=np.uint8)
        framed[np.arange(len(part)) + extra * row + ORDER] = part
        framed[at[1:] + extra * np.arange(1, n + 1) - 1] = END
        runs = np.zeros(len(framed) - ORDER, dtype=np.int64)
        for k in range(extra):
            runs = (runs << 8) | framed[k:len(framed) - ORDER + k]
        coded = framed[ORDER:] != START
        run_row = np.repeat(np.arange(n), np.diff(at) + 1)
        yield a, _chunk(part, at, a), runs[coded], run_row
        a = b


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    """Words have negative keys, runs have keys of ``ORDER`` + 1 bytes."""
    return (hashes | np.uint64(1 << 63)).astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(back, weights=np.concatenate(counts), minlength=len(unique)).astype(np.int64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, ascending, by sorting: faster than the hash table of ``np.unique``."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _marked(keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, none negative, and how many of each are marked. Keys
    and marks are sorted as one number, faster than places are sorted."""
    both = np.sort((keys << 1) | marks)
    starts = np.flatnonzero(np.append(True, both[1:] >> 1 != both[:-1] >> 1)) if len(both) else np.zeros(0, dtype=np.int64)
    marked = np.concatenate([[0], np.cumsum(both & 1)])
    return both[starts] >> 1, np.diff(marked[np.append(starts, len(both))])


class _Places:
    """Places of keys in an array of distinct ones, by a table of hashes: a
    key is found in a step or two, where a binary search takes twenty."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        hashed = self._hash(keys)
        self.order = np.argsort(hashed)
        self.keys = keys[self.order]
        self.start = np.zeros(1 << bits, dtype=np.int64)
        self.start[1:] = np.cumsum(np.bincount(hashed, minlength=1 << bits))[:-1]

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """Places of keys that the array holds (others raise)."""
        at = self.start[self._hash(wanted)]
        open_ = np.flatnonzero(self.keys[at] != wanted) if len(wanted) else at
        while len(open_):
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] != wanted[open_]]
        return self.order[at]


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(key, n): training counts of words and runs; runs of held-out rows
    alone have the count 0. ``docs``: (doc_id, text, held_out)."""
    @thrifty
    def count(batches):
        keys, counts, size = [], [], 0

        def out():
            k, n = _summed(keys, counts)
            keys.clear()
            counts.clear()
            for i in range(0, len(k), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(k[i:i + (1 << 17)]), pa.array(n[i:i + (1 << 17)])], names=["key", "n"])

        for batch in batches:
            teaches = ~np.array(batch.column(2).to_pylist(), dtype=bool)
            for first, words, runs, run_row in _pieces(batch.column(1)):
                known = teaches[first:first + words.rows]
                word_row = np.repeat(np.arange(words.rows), np.diff(words.bounds))
                for k, n in (np.unique(_word_keys(words.hashes[known[word_row]]), return_counts=True), _marked(runs, known[run_row])):
                    keys.append(k)
                    counts.append(n)
                    size += len(k)
            if size > _FLUSH:
                k, n = _summed(keys, counts)
                keys[:], counts[:], size = [k], [n], len(k)
                if size > _FLUSH // 2:
                    yield from out()
                    size = 0
        if keys:
            yield from out()

    return docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _escape_costs(seen: np.ndarray, ruled_out: np.ndarray) -> tuple[np.ndarray, float]:
    """log10 probabilities of the symbols (-inf if unseen or ruled out) in a
    context with counts ``seen``, and of the escape."""
    counts = np.where(ruled_out, 0, seen)
    distinct = np.count_nonzero(counts)
    if not distinct:
        return np.full(256, -np.inf), 0.0
    total = counts.sum() + distinct
    with np.errstate(divide="ignore"):
        return np.log10(counts / total), math.log10(distinct / total)


def context_costs(chain: list[np.ndarray]) -> np.ndarray:
    """log10 probability of every symbol, given the counts of the contexts
    from the longest to the empty one."""
    ruled_out = np.zeros(256, dtype=bool)
    ruled_out[START] = True
    result = np.full(256, -np.inf)
    escaped = 0.0
    for seen in chain:
        symbols, escape = _escape_costs(seen, ruled_out)
        now = np.isfinite(symbols)
        result[now] = escaped + symbols[now]
        ruled_out |= now
        escaped += escape
    rest = ~ruled_out
    if rest.any():
        result[rest] = escaped - math.log10(np.count_nonzero(rest))
    return result


def run_costs(runs: DataFrame) -> DataFrame:
    """(key, value): log10 probability of the last byte of each run after the
    bytes before it. ``runs``: (key, n)."""
    low = np.zeros((256, 256))
    pairs = runs.groupBy(F.expr("key & 65535").alias("pair")).agg(F.sum("n").alias("n"))
    for pair, n in pairs.collect():                        # at most 65,536 rows
        low[pair >> 8, pair & 255] = n
    zero = low.sum(axis=0)

    def cost(key, table):
        keys, n = table.column("key").to_numpy(), table.column("n").to_numpy()
        symbol, last, older = keys & 255, int(keys[0] >> 8) & 255, keys >> 24
        shared = [np.bincount(symbol, weights=n, minlength=256), low[last], zero]
        value = np.zeros(len(keys))

        def descend(rows, size, longer):
            """Codes the rows, which agree in ``size`` of the older bytes;
            ``longer`` holds the counts of the contexts met on the way."""
            if size == ORDER - 2:
                value[rows] = context_costs([*longer, *shared])[symbol[rows]]
                return
            byte = (older[rows] >> (8 * size)) & 255
            order = np.argsort(byte, kind="stable")
            for part in np.split(rows[order], np.flatnonzero(np.diff(byte[order])) + 1):
                descend(part, size + 1, [np.bincount(symbol[part], weights=n[part], minlength=256), *longer])

        descend(np.arange(len(keys)), 0, [])
        return pa.table({"key": pa.array(keys), "value": pa.array(value)})

    return (runs.withColumn("middle", F.expr("(key >> 8) & 65535")).groupBy("middle")
            .applyInArrow(cost, "key long, value double"))


def ppm_scores(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
               chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row. ``held_out`` (a condition on doc_id) defaults to remainder 2
    of the crc32 of the id by 7."""
    held = held_out if held_out is not None else F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    docs = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .withColumn("held_out", F.coalesce(held, F.lit(False))))
    counts = stored(corpus_counts(docs), "counts")
    words, runs = counts.where("key < 0"), counts.where("key >= 0")
    n_docs, n_train, size = docs.agg(F.count("*"), F.count_if(~F.col("held_out")), F.sum(F.octet_length("text"))).first()
    word_tokens, word_kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_tokens, n_kinds = word_tokens + n_train, word_kinds + (n_train > 0)
    # words answer by their counts: exact, and short once compressed, which logarithms
    # are not; code lengths are rounded to 24 bits, which halves what the answers take
    costs = run_costs(runs).withColumn("value", F.col("value").cast("float").cast("double"))
    values = stored(words.select("key", F.col("n").cast("double").alias("value")).unionByName(costs), "values")

    chunks = max(1, math.ceil((size or 0) / chunk_bytes))
    parts = min(chunks, MAX_PARTITIONS)                      # a partition may hold several chunks
    single, repeated = folded(docs)
    dealt = (single.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
             .select("chunk", "doc_id", "text", "held_out", "copies").repartition(parts, "chunk"))

    @thrifty
    def ask(batches):
        now, keys, size = None, [], 0

        def out():
            k = _distinct(np.concatenate(keys))
            keys.clear()
            for i in range(0, len(k), 1 << 17):
                part = k[i:i + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now, dtype=np.int32)), pa.array(part)], names=["chunk", "key"])

        for batch in batches:
            own = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(own)]):
                if a == b:
                    continue
                if keys and (own[a] != now or size > _FLUSH):
                    yield from out()
                    size = 0
                now = int(own[a])
                for _, words_, runs_, _ in _pieces(batch.column(2).slice(a, b - a)):
                    keys += [_distinct(_word_keys(words_.hashes)), _distinct(runs_)]
                    size += len(keys[-1]) + len(keys[-2])
        if keys:
            yield from out()

    asked = dealt.sortWithinPartitions("chunk").mapInArrow(ask, "chunk int, key long")
    answers = (asked.join(values, "key", "left").select("chunk", "key", F.coalesce("value", F.lit(0.0)).alias("value"))
               .repartition(parts, "chunk"))
    log_total = math.log10(n_tokens + n_kinds + 1)
    log_end = math.log10(n_train + 1)
    exact = pa.float64()

    @thrifty
    def score(texts, found):
        places, value = _Places(found.column("key").to_numpy()), found.column("value").to_numpy()
        column = texts.column("text").combine_chunks() if texts.num_rows else pa.array([], pa.string())
        n = texts.num_rows
        tokens, known, base, total = np.ones(n, dtype=np.int64), np.full(n, int(n_train > 0)), np.full(n, log_end - log_total), np.zeros(n)
        for first, words_, runs_, run_row in _pieces(column):
            own = slice(first, first + words_.rows)
            word_row = np.repeat(np.arange(words_.rows), np.diff(words_.bounds))
            count = value[places.of(_word_keys(words_.hashes))]
            v = np.log10(count + 1.0)
            tokens[own] += np.diff(words_.bounds)
            known[own] += np.bincount(word_row[v > 0], minlength=words_.rows)
            base[own] += np.bincount(word_row, weights=v - log_total, minlength=words_.rows)
            total[own] += np.bincount(run_row, weights=value[places.of(runs_)], minlength=words_.rows)
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "copies": texts.column("copies"), "n_tokens": pa.array(tokens),
                         "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(n, n_tokens, dtype=np.int64)),
                         "base_score": pa.array(base, exact), "score": pa.array(total, exact)})

    scored = (dealt.groupBy("chunk").cogroup(answers.groupBy("chunk"))
              .applyInArrow(score, "doc_id long, held_out boolean, copies long, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return unfolded(scored, repeated)
