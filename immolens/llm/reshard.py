"""Resharding by minimum-cost flow.

Rows lie in old shards; new shards have capacities in rows. A block is the
rows of one old shard within one size class (a half octave). Moving a row
costs the mean bytes of its block, staying costs nothing. The flow

    block -> own shard (free), block -> pool (mean bytes a row) -> any shard

with the capacities at the shards is solved exactly on the driver, from the
block counts alone: their number is bounded by shards times size classes and
does not depend on the rows. Its solution says how many rows of each block
stay and where the others go; the moves form lanes (block, from rank, to
rank, new shard). Ranks within a block are the sum of a cell's offset and the
row's number in its cell. Cells split a block into ``SIZE_STEPS`` steps of size,
and a step by a hash of id, checksum and a number that every row is given (so
equal rows part as well), so that none holds more than about ``CELL_ROWS``
rows. Cells of larger rows come first and stay, as do larger rows within a
cell: which rows of a block move is decided by size to within a step, 1/64
of a half octave. ``rewrite_affected`` writes the shards that gained or lost rows.

The law is ``rows``: new shards differ by at most one row.

Cases: a null text has no bytes (size 16, checksum 0). Every row is placed,
also repeated ones and rows with equal texts or without id. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from immolens.llm.tables import stored

ROW_BYTES = 16           # added to each text
OLD_SHARDS, NEW_SHARDS = 32, 40
CELL_ROWS = 20_000
SIZE_STEPS = 64          # of a size class


class FlowNetwork:
    """Minimum-cost flow by primal-dual phases: shortest paths with
    potentials, then augmentation along all arcs of reduced cost zero."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[float] = []

    def add(self, a: int, b: int, room: int, cost: int = 0) -> int:
        arc = len(self.to)
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return arc

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def _distances(self, source: int, potential: list[int]) -> list[float]:
        far = [math.inf] * len(self.arcs)
        far[source] = 0
        heap = [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for arc in self.arcs[x]:
                if self.room[arc]:
                    y = self.to[arc]
                    new = d + self.cost[arc] + potential[x] - potential[y]
                    if new < far[y]:
                        far[y] = new
                        heapq.heappush(heap, (new, y))
        return far

    def solve(self, source: int, sink: int) -> int:
        """Sends as much as fits at the least cost; returns the cost."""
        potential = [0] * len(self.arcs)
        total = 0
        while True:
            far = self._distances(source, potential)
            if far[sink] == math.inf:
                return total
            potential = [p + int(min(f, far[sink])) for p, f in zip(potential, far)]
            total += self._augment(source, sink, potential) * (potential[sink] - potential[source])

    def _augment(self, source: int, sink: int, potential: list[int]) -> int:
        sent = 0
        nexts = [0] * len(self.arcs)
        dead = [False] * len(self.arcs)
        path: list[int] = []
        on_path = {source}
        x = source
        while True:
            if x == sink:
                amount = min(self.room[a] for a in path)
                sent += amount
                for a in path:
                    self.room[a] -= amount
                    self.room[a ^ 1] += amount
                cut = next(i for i, a in enumerate(path) if not self.room[a])
                x = self.to[path[cut] ^ 1]
                for a in path[cut:]:
                    on_path.discard(self.to[a])
                del path[cut:]
                continue
            while nexts[x] < len(self.arcs[x]):
                arc = self.arcs[x][nexts[x]]
                y = self.to[arc]
                if (self.room[arc] and not dead[y] and y not in on_path
                        and self.cost[arc] + potential[x] - potential[y] == 0):
                    break
                nexts[x] += 1
            else:
                if x == source:
                    return sent
                dead[x] = True
                on_path.discard(x)
                x = self.to[path.pop() ^ 1]
                continue
            path.append(arc)
            x = y
            on_path.add(x)


def plan_transfers(blocks: list[tuple[int, int, int, int]], capacities: list[int]) -> tuple[list[tuple], int]:
    """``blocks``: (old shard, size class, rows, bytes). Returns lanes
    (old shard, size class, first rank, end rank, new shard, first slot) that
    place every row, and the bytes moved by the blocks' means."""
    blocks = sorted(blocks, key=lambda b: (b[0], -b[1]))
    pool, first_shard = len(blocks), len(blocks) + 1
    source, sink = first_shard + len(capacities), first_shard + len(capacities) + 1
    net = FlowNetwork(sink + 1)
    own, moved = {}, {}
    for i, (old, _, rows, size) in enumerate(blocks):
        net.add(source, i, rows)
        if old < len(capacities):
            own[i] = net.add(i, first_shard + old, rows)
        moved[i] = net.add(i, pool, rows, round(size / rows))
    for s, room in enumerate(capacities):
        net.add(first_shard + s, sink, room)
    from_pool = [net.add(pool, first_shard + s, sum(capacities)) for s in range(len(capacities))]
    cost = net.solve(source, sink)
    slots: dict[int, int] = defaultdict(int)
    lanes = []

    def put(i: int, first: int, rows: int, shard: int):
        if rows:
            lanes.append((blocks[i][0], blocks[i][1], first, first + rows, shard, slots[shard]))
            slots[shard] += rows

    wanted = [(s, net.flow(a)) for s, a in enumerate(from_pool) if net.flow(a)]
    for i, (old, _, rows, _) in enumerate(blocks):
        kept = net.flow(own[i]) if i in own else 0
        put(i, 0, kept, old)
        rank = kept
        while rank < rows:
            shard, room = wanted[-1]
            n = min(room, rows - rank)
            put(i, rank, n, shard)
            rank += n
            wanted[-1] = (shard, room - n)
            if n == room:
                wanted.pop()
    return lanes, cost


def even_capacities(old_rows: dict[int, int], shards: int) -> list[int]:
    """Row capacities at most one apart; the larger ones where most rows are."""
    total = sum(old_rows.values())
    capacities = [total // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-old_rows.get(s, 0), s))[:total % shards]:
        capacities[s] += 1
    return capacities


def reshard(docs: DataFrame, shards: int = NEW_SHARDS, old_shard: Column | None = None,
            capacities: list[int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The new place of every row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, old_shard. ``old_shard`` (int, not null) defaults to a hash
    of the id over 32 shards."""
    old = old_shard if old_shard is not None else F.pmod(F.xxhash64(id_col), F.lit(OLD_SHARDS))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("bytes"),
                    F.crc32(text).alias("text_crc32"), old.cast("int").alias("old_shard"))
        .withColumn("size", F.col("bytes") + ROW_BYTES)
        .withColumn("size_class", F.floor(F.log2("size") * 2).cast("int"))
        .withColumn("size_step", F.floor((F.log2("size") * 2 - F.col("size_class")) * SIZE_STEPS).cast("int"))
        .withColumn("number_given", F.monotonically_increasing_id()), "sizes")        # written, so it does not change
    blocks = [tuple(r) for r in rows.groupBy("old_shard", "size_class").agg(F.count("*"), F.sum("size")).collect()]
    old_rows: dict[int, int] = defaultdict(int)
    for shard, _, n, _ in blocks:
        old_rows[shard] += n
    total = sum(old_rows.values())
    capacities = capacities or even_capacities(old_rows, shards)
    if sum(capacities) < total:
        raise ValueError("the capacities are smaller than the table")
    lanes, _ = plan_transfers(blocks, capacities)

    block = ["old_shard", "size_class"]
    largest = rows.groupBy(*block, "size_step").count().agg(F.max("count")).first()[0] or 0
    cells = max(1, math.ceil(largest / CELL_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "number_given"), F.lit(cells)))
    cell = [*block, "size_step", "part"]
    before = Window.partitionBy(*block).orderBy(F.desc("size_step"), "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*cell).count().select(*cell, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    in_cell = Window.partitionBy(*cell).orderBy(F.desc("size"), "doc_id", "text_crc32")
    ranked = (rows.withColumn("number", F.row_number().over(in_cell) - 1).join(offsets, cell)
              .withColumn("rank", F.col("offset") + F.col("number")))
    spark = docs.sparkSession
    lane_rows = spark.createDataFrame(lanes, "old_shard int, size_class int, first long, end long, shard int, first_slot long")
    return (ranked.join(F.broadcast(lane_rows), block)             # at most one lane per block and new shard
            .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "old_shard"))


def rewrite_affected(docs: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     old_shard: Column | None = None) -> list[int]:
    """Writes the shards that gained or lost rows as Parquet under
    ``path/shard=<n>``, in slot order; returns their numbers. Rows find their
    places by id (also null), size, checksum and occurrence number, so every
    row is written once. An ``old_shard`` that does not follow from id and text
    must be given here as to ``reshard``. Other shards' files need no change."""
    moved = places.where(F.col("shard") != F.col("old_shard"))
    affected = sorted({r[0] for r in moved.select(F.explode(F.array("shard", "old_shard"))).distinct().collect()})
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select("*", F.col(id_col).cast("long").alias("_id"), (F.octet_length(text).cast("long") + ROW_BYTES).alias("_size"),
                      F.crc32(text).alias("_crc"), (old_shard if old_shard is not None else F.lit(0)).cast("int").alias("_old"))
    own = own.withColumn("_copy", F.row_number().over(Window.partitionBy("_id", "_size", "_crc", "_old").orderBy(F.xxhash64(*names))))
    keep = places.select("doc_id", "size", "text_crc32", F.col("old_shard") if old_shard is not None else F.lit(0).alias("old_shard"),
                         F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    copies = Window.partitionBy("doc_id", "size", "text_crc32", "old_shard").orderBy("_shard", "_slot")
    keep = (keep.withColumn("copy", F.row_number().over(copies)).where(F.col("_shard").isin(affected))
            .toDF("_p_id", "_p_size", "_p_crc", "_p_old", "_shard", "_slot", "_p_copy"))
    same = [F.col(f"_{c}").eqNullSafe(F.col(f"_p_{c}")) for c in ("id", "size", "crc", "old", "copy")]
    (own.join(keep, same).select(*names, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    return affected
