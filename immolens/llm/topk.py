"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to integers and cut into blocks. The index holds one
row per block: for every attribute (component) its smallest value and the
bitmaps ("slices") of ``value - smallest``, one bit per row of the block.

A query adds slices with bitmap arithmetic: the slices of attribute ``d``,
shifted by ``j``, are added for every set bit ``j`` of the query's component;
a negative component adds the complemented slices, which stand for
``2^bits - 1 - value``. Bitmaps of one weight are reduced with full adders,
three to a sum and a carry, for all rows of a block at once. The result is
the score in slices. The best rows are found from the most significant slice
down: rows surely among the best, and rows still tied; the rows tied at the
end share one score, and the smallest ids among them fill up the result.

Queries and index rows are both blocked. Index blocks form groups, about as
many as there are tasks, and the small side, the query blocks, is sent to each
group once; a task holds one index block and one query block at a time. The
best ``k`` of each block are merged per query by a window. Nothing is collected.

Cases: a vector that is null or holds a null, NaN or infinite component
takes no part; neither does a row without id. Rows that repeat an id all take
part: each is a candidate for other ids, and queries of one id share its ``k``
results. Rows are dealt to blocks by place as well as id, so repeated rows
spread. Ties go to the smaller id. A shorter vector counts as padded with
zeros; an empty one scores 0 everywhere. Empty tables give no rows. Scores are
added up exactly at any size; a reported score that does not fit 64 bits, or a
quantised component beyond 2^61, raises an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
BLOCK_ROWS = 16384
QUERY_BLOCK_ROWS = 128
MAX_COMPONENT = 1 << 61

_INDEX = "block int, n int, dims int, ids binary, low binary, bits binary, slices binary"
_QUERIES = "query_block int, n int, dims int, query_ids binary, matrix binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id long, v array<long>) of the rows that take part."""
    def usable(x: Column) -> Column:
        d = x.cast("double")
        return F.coalesce(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), F.lit(False))

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("raw"))
    return (rows.where(F.col("id").isNotNull() & F.col("raw").isNotNull() & F.coalesce(F.forall("raw", usable), F.lit(False)))
            .select("id", F.transform("raw", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order (repeated ones too), and their vectors."""
    rows = sorted(zip(table.column("id").to_pylist(), table.column("v").to_pylist()))
    dims = max((len(v) for _, v in rows), default=0)
    matrix = np.zeros((len(rows), dims), dtype=np.int64)
    for k, (_, v) in enumerate(rows):
        matrix[k, :len(v)] = v
    if matrix.size and (matrix.max() > MAX_COMPONENT or matrix.min() < -MAX_COMPONENT):
        raise ValueError(f"a quantised component exceeds {MAX_COMPONENT}")
    return np.array([i for i, _ in rows], dtype=np.int64), matrix


def _one_row(values: dict, schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([values[name]], kinds[kind]) for name, kind in fields})


def slice_block(ids: np.ndarray, matrix: np.ndarray) -> dict:
    """The bit slices of one block: slice ``b`` of attribute ``d`` is a bitmap
    of 64-bit words, attributes in order, least significant slice first."""
    n, dims = matrix.shape
    words = max(1, -(-n // 64))
    low = matrix.min(axis=0) if n else np.zeros(dims, dtype=np.int64)
    above = matrix - low
    bits = np.array([int(x).bit_length() for x in (above.max(axis=0) if n else np.zeros(dims, dtype=np.int64))], dtype=np.int32)
    out = []
    padded = np.zeros((words * 64, dims), dtype=np.int64)
    padded[:n] = above
    for d in range(dims):
        for b in range(bits[d]):
            out.append(np.packbits(((padded[:, d] >> b) & 1).astype(np.uint8), bitorder="little").tobytes())
    return {"n": n, "dims": dims, "ids": ids.tobytes(), "low": low.tobytes(), "bits": bits.tobytes(), "slices": b"".join(out)}


class SlicedBlock:
    """One index block, ready to be queried."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.low = np.frombuffer(row["low"], dtype=np.int64)
        self.bits = np.frombuffer(row["bits"], dtype=np.int32)
        words = max(1, -(-self.n // 64))
        slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(-1, words)
        self.total = len(slices)
        self.both = np.concatenate([slices, ~slices])            # complemented slices for negative components
        self.first = np.cumsum(self.bits) - self.bits
        self.all = np.packbits(np.arange(words * 64) < self.n, bitorder="little").view(np.uint64)

    def scores(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of ``score - base`` of all rows, and ``base``."""
        dims = len(self.low)
        q = q[:dims]
        size = np.abs(q)
        base = int((q.astype(object) * self.low[:len(q)]).sum()) if len(q) else 0
        negative = q < 0
        full = (1 << self.bits[:len(q)].astype(np.int64)) - 1
        base -= int((size[negative].astype(object) * full[negative]).sum())
        top = int(size.max()).bit_length() if len(q) else 0
        pick, weight = [], []
        for j in range(top):
            d = np.flatnonzero((size >> j) & 1)
            count = self.bits[d].astype(np.int64)
            b = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pick.append(np.repeat(self.first[d] + self.total * negative[d], count) + b)
            weight.append(b + j)
        if not pick:
            return [], base
        pick, weight = np.concatenate(pick), np.concatenate(weight)
        out, carried, w = [], [], 0
        most = int(weight.max()) if len(weight) else -1
        while w <= most or carried:
            rows = np.concatenate([self.both[pick[weight == w]], *carried])
            carried = []
            while len(rows) > 2:
                k = len(rows) // 3
                a, b, c = rows[:k], rows[k:2 * k], rows[2 * k:3 * k]
                half = a ^ b
                carried.append((a & b) | (c & half))
                rows = np.concatenate([half ^ c, rows[3 * k:]])
            if len(rows) == 2:
                carried.append((rows[:1] & rows[1:]))
                rows = rows[:1] ^ rows[1:]
            out.append(rows[0] if len(rows) else np.zeros_like(self.all))
            w += 1
        return out, base

    def best(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the ``k`` best rows other than the query's own."""
        slices, base = self.scores(q)
        tied = self.all.copy()
        for own in range(np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, side="right")):
            tied[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        sure = np.zeros_like(tied)
        need = k
        for s in reversed(slices):
            ones = tied & s
            count = int(np.bitwise_count(ones).sum())
            if count > need:
                tied = ones
            else:
                sure |= ones
                need -= count
                tied = tied & ~s
                if not need:
                    break
        rows = _positions(sure)
        if need:
            rows = np.concatenate([rows, _positions(tied)[:need]])
        total = np.zeros(len(rows), dtype=object) + base
        for w, s in enumerate(slices):
            total += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(object) << w
        return list(zip(self.ids[rows].tolist(), total.tolist()))


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _dealt(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")


def build_index(vectors: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index of ``quantised`` rows, one row per block of about
    ``block_rows`` vectors; blocks are dealt by a hash of the id and the row's
    place."""
    blocks = max(1, math.ceil(n_rows / block_rows))

    def build(key, table):
        return _one_row({"block": key[0].as_py(), **slice_block(*_matrix(table))}, _INDEX)

    return (vectors.withColumn("block", _dealt(blocks))
            .groupBy("block").applyInArrow(build, _INDEX))


def search(index: DataFrame, queries: DataFrame, k: int, n_rows: int, n_queries: int,
           block_rows: int = BLOCK_ROWS, query_block_rows: int = QUERY_BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best index rows of every
    query. ``n_rows`` must be the count given to ``build_index``."""
    blocks = max(1, math.ceil(n_rows / block_rows))
    query_blocks = max(1, math.ceil(n_queries / query_block_rows))

    def gather(key, table):
        ids, matrix = _matrix(table)
        return _one_row({"query_block": key[0].as_py(), "n": len(ids), "dims": matrix.shape[1],
                         "query_ids": ids.tobytes(), "matrix": matrix.tobytes()}, _QUERIES)

    def look_up(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                block = SlicedBlock(row)
                ids = np.frombuffer(row["query_ids"], dtype=np.int64)
                matrix = np.frombuffer(row["matrix"], dtype=np.int64).reshape(len(ids), row["query_dims"])
                found = [(int(q), v, s) for q, x in zip(ids, matrix) for v, s in block.best(int(q), x, k)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                     names=["query_id", "vec_id", "score"])

    groups = min(blocks, 2 * index.sparkSession.sparkContext.defaultParallelism)
    asked = (queries.withColumn("query_block", _dealt(query_blocks)).groupBy("query_block").applyInArrow(gather, _QUERIES)
             .select("query_block", F.col("dims").alias("query_dims"), "query_ids", "matrix",
                     F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")))
    offered = index.withColumn("group", F.pmod("block", F.lit(groups)))
    found = offered.join(asked, "group").mapInArrow(look_up, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` best rows by inner product for every row whose ``id``
    satisfies ``is_query`` (a condition on the column ``id``)."""
    rows = quantised(vectors, id_col, vector_col)
    n_rows, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    return search(build_index(rows, n_rows, block_rows), rows.where(is_query), k, n_rows, n_queries, block_rows)
