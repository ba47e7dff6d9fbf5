"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct five-word shingles. Two documents are
linked if their Jaccard similarity is at least 0.75, and a component is what
links connect.

1. One pass over the texts gives each document's set size, a 128-bit hash of
   the set, and 128 SetSketch registers: the smallest of exponentially
   distributed hashes of the set, truncated to ``1 - log_b``. Registers of a
   union are the maxima of the registers, so sketches can be merged.
2. Documents with equal sets form a class; one representative goes on.
3. Four registers make a band. With 32 bands a pair at 0.75 shares none with
   a chance of 5e-6. In each bucket the members are paired with the smallest
   id only.
4. A pair is dropped if the sizes rule out 0.75, or if the joint likelihood
   of its registers, given both sizes, is lower at 0.75 than at its maximum by
   more than ``MARGIN`` (five standard deviations). The rest is verified on
   the full sets.
5. Components of the links found so far; then, in buckets that still hold more
   than one component, the members outside the bucket's largest component are
   compared with all others by their registers, block by block, and only
   (document, component) is noted where some pair is plausible. Each noted
   document is compared on the full sets with that component, again in blocks,
   and at most one link a block is returned. So every pair of a bucket is
   either tested or known to be connected, and the rows that are shuffled
   follow the documents, not their pairs.

Only ids, sizes, registers and pairs are shuffled, plus the texts of documents
in a pair. Cases: a null or empty text, or one of white space, has an empty
set and is linked with nothing; fewer than five words are one shingle. A row
without id takes no part (component null, kept). Repeated rows give repeated
rows; different texts under one id share its links. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.graph import components
from immolens.llm.hashing import gather_runs, mix64
from immolens.llm.memory import thrifty
from immolens.llm.tables import stored
from immolens.llm.words import shingle_sets

REGISTERS = 128
BAND = 4
BASE = 1.001              # ratio of neighbouring register values
RATE = 20.0               # scale of the exponential hashes
LIMIT = (1 << 16) - 2     # registers lie in 0 .. LIMIT + 1
NUM, DEN = 75, 100        # the similarity is NUM / DEN
MARGIN = 12.5
FLOOR = 0.4               # share of equal registers below which no likelihood is computed
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 200_000
BROADCAST_IDS = 500_000
CLASS_ROWS = 1000         # rows of one class that are shuffled together
CLASS = ["h1", "h2", "n_shingles"]
_OPEN = ["bucket", "block", "doc_id", "component", "largest", "n_shingles", "registers"]

_RNG = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_MULTIPLY, _ADD = _RNG[:REGISTERS] | np.uint64(1), _RNG[REGISTERS:]


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a set of hashes; zeros if it is empty."""
    if not len(shingles):
        return np.zeros(REGISTERS, dtype=np.uint16)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 1024):
        hashed = shingles[a:a + 1024, None] * _MULTIPLY
        hashed += _ADD
        np.minimum(least, hashed.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    smallest = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def _log_likelihood(j, greater, less, equal, u, v):
    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    tiny = 1e-12
    more, fewer = p(u - v * j), p(v - u * j)
    return (greater * np.log(np.maximum(more, tiny)) + less * np.log(np.maximum(fewer, tiny))
            + equal * np.log(np.maximum(1 - more - fewer, tiny)))


def plausible(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which pairs may have the similarity: register rows and set sizes of
    both sides; the joint likelihood of (registers | sizes, J) decides."""
    greater, equal = (ra > rb).sum(axis=1), (ra == rb).sum(axis=1)
    less = ra.shape[1] - greater - equal
    u = na / (na + nb)
    v = 1 - u
    wanted = NUM / DEN
    at = _log_likelihood(wanted, greater, less, equal, u, v)
    best = at.copy()
    for j in np.linspace(0, wanted, 25)[:-1]:
        best = np.maximum(best, _log_likelihood(j, greater, less, equal, u, v))
    return best - at <= MARGIN


_SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, registers binary"


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, set hash and registers of every row."""
    @thrifty
    def sketch(batches):
        for batch in batches:
            n, h1, h2, regs = [], [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                h1.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))).astype(np.int64)) if len(s) else 0)
                regs.append(registers(s).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "h1", "h2", "registers"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sketch, _SKETCH)


def _similar_sizes(a: Column, b: Column) -> Column:
    return (F.least(a, b) * DEN >= F.greatest(a, b) * NUM)


def _filter_by_likelihood(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    side = reps.select("doc_id", "n_shingles", "registers")
    rows = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
            .where(_similar_sizes(F.col("na"), F.col("nb"))).select("a", "b", "na", "nb", "ra", "rb"))

    @thrifty
    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for c in ("ra", "rb"))
            ok = plausible(ra, rb, batch.column("na").to_numpy(zero_copy_only=False), batch.column("nb").to_numpy(zero_copy_only=False))
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return rows.mapInArrow(keep, "a long, b long")


def texts_of(docs: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose id is in ``ids``: by a
    broadcast of at most ``BROADCAST_IDS`` ids, else by a shuffle."""
    return docs.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``doc_id``s whose full sets are similar enough."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(texts_of(docs, ids, 2 * pairs.count()), "texts")
    rows = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    @thrifty
    def check(batches):
        for batch in batches:
            ok = []
            for sa, sb in zip(shingle_sets(batch.column("ta")), shingle_sets(batch.column("tb"))):
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                ok.append(both > 0 and DEN * both >= NUM * (len(sa) + len(sb) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(check, "a long, b long").distinct()


def _open_pairs(placed: DataFrame, reps: DataFrame) -> DataFrame:
    """(x, target): documents and other components of a common bucket of
    which some pair is plausible by its registers. ``placed``: (bucket,
    doc_id, component)."""
    sizes = placed.groupBy("bucket", "component").count()
    buckets = (sizes.groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("parts"), F.sum("count").alias("size"))
               .where("parts > 1").select("bucket", F.col("top.component").alias("largest"), F.ceil(F.col("size") / BLOCK_DOCS).cast("int").alias("blocks")))
    rows = stored(placed.join(buckets, "bucket").join(reps.select("doc_id", "n_shingles", "registers"), "doc_id"), "open")    # all texts of an id
    members = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).select(*_OPEN)
    asking = rows.where("component != largest").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*_OPEN)

    def regs(table):
        return np.frombuffer(b"".join(table.column("registers").to_pylist()), dtype="<u2").reshape(table.num_rows, -1)

    @thrifty
    def compare(offered, asked):
        found = set()
        if offered.num_rows and asked.num_rows:
            ry, rx = regs(offered), regs(asked)
            (dy, cy, ny), (dx, cx, nx) = ([t.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles")] for t in (offered, asked))
            top = offered.column("largest")[0].as_py()
            for k in range(len(dx)):
                ok = (cy != cx[k]) & ((cy == top) | (dx[k] < dy)) & (DEN * np.minimum(ny, nx[k]) >= NUM * np.maximum(ny, nx[k]))
                at = np.flatnonzero(ok)
                at = at[(ry[at] == rx[k]).mean(axis=1) >= FLOOR]        # far below what MARGIN admits
                if len(at):
                    at = at[plausible(np.broadcast_to(rx[k], (len(at), rx.shape[1])), ry[at], np.full(len(at), nx[k]), ny[at])]
                    found.update((int(dx[k]), int(c)) for c in np.unique(cy[at]))
        return pa.table({"x": pa.array([f[0] for f in found], pa.int64()), "target": pa.array([f[1] for f in found], pa.int64())})

    return (members.groupBy("bucket", "block").cogroup(asking.groupBy("bucket", "block"))
            .applyInArrow(compare, "x long, target long").distinct())


def _links_to_components(pairs: DataFrame, found: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (a, b) between documents x and members of components:
    for each x and block of a target, one if there is any."""
    pairs = stored(pairs, "open-pairs")
    sizes = reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    asked = pairs.groupBy("target").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("groups"))
    in_target = (sizes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                 .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("target")).join(asked, "target"))
    blocks = in_target.groupBy("target").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    offers = (in_target.join(blocks, "target").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
              .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("target", "block", "group", "doc_id"))
    asks = (pairs.join(asked, "target").join(blocks, "target").withColumn("group", F.pmod(F.xxhash64("x"), F.col("groups")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("target", "block", "group", F.col("x").alias("doc_id")))
    ids = stored(offers.select("doc_id").unionByName(asks.select("doc_id")).distinct(), "ids")
    texts = stored(texts_of(docs, ids, ids.count()), "texts")
    key = ["target", "block", "group"]

    @thrifty
    def verify(offered, asked):
        out = []
        if offered.num_rows and asked.num_rows:
            sets = list(shingle_sets(offered.column("text")))
            size = np.array([len(s) for s in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            order = np.argsort(flat)
            flat, owner = flat[order], owner[order]
            y, x = offered.column("doc_id").to_pylist(), asked.column("doc_id").to_pylist()
            for k, s in enumerate(shingle_sets(asked.column("text"))):
                low, high = np.searchsorted(flat, s), np.searchsorted(flat, s, side="right")
                both = np.bincount(owner[gather_runs(np.arange(len(flat)), low, high - low)], minlength=len(sets))
                hit = np.flatnonzero((both > 0) & (DEN * both >= NUM * (size + len(s) - both)) & (np.array(y) != x[k]))
                if len(hit):
                    other = y[int(hit[0])]
                    out.append((min(other, x[k]), max(other, x[k])))
        return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})

    return (offers.join(texts, "doc_id").groupBy(*key).cogroup(asks.join(texts.toDF("doc_id", "text"), "doc_id").groupBy(*key))
            .applyInArrow(verify, "a long, b long").distinct())


def _of_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, rep) of the rows. Classes of more than ``CLASS_ROWS`` rows are
    broadcast, at most ``BROADCAST_IDS`` of them, so that their rows stay where
    they are; the others are shuffled, and beyond that number all."""
    large = stored(classes.where(F.col("size") > CLASS_ROWS), "large")
    if not 0 < large.count() <= BROADCAST_IDS:
        return rows.join(classes, CLASS).select("doc_id", "rep")
    near = rows.join(F.broadcast(large), CLASS).select("doc_id", "rep")
    far = rows.join(F.broadcast(large), CLASS, "left_anti").join(classes.where(F.col("size") <= CLASS_ROWS), CLASS).select("doc_id", "rep")
    return near.unionByName(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    all_rows = stored(sketches(docs), "sketches")
    linkable = all_rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(linkable.groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")), "classes")
    reps = stored(linkable.join(classes.select(*CLASS, F.col("rep").alias("doc_id")), ["doc_id", "h1", "h2", "n_shingles"], "left_semi")
                  .dropDuplicates(["doc_id", "h1", "h2"]), "reps")

    bands = REGISTERS // BAND
    buckets = reps.select("doc_id", "n_shingles", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "registers").select(
        F.xxhash64("band", F.substr("registers", F.col("band") * (2 * BAND) + 1, F.lit(2 * BAND))).alias("bucket"), "doc_id")
    shared = (buckets.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
              .where(F.col("a") < F.col("z")).select("bucket", "a"))
    crowded = stored(buckets.join(shared, "bucket"), "buckets")          # members of buckets with company
    first = crowded.where(F.col("doc_id") != F.col("a")).select("a", F.col("doc_id").alias("b")).distinct()
    links = stored(verified(_filter_by_likelihood(first, reps), docs), "links")

    found = components(links)
    placed = stored(crowded.select("bucket", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                    .select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")), "placed")
    more = stored(_links_to_components(_open_pairs(placed, reps), found, reps, docs), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    members = _of_classes(linkable.select("doc_id", *CLASS), classes)
    # one id may stand for several texts: all their classes belong together
    placed_docs = (members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                   .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")))
    return (all_rows.select("doc_id", "n_shingles").join(placed_docs, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, of which one stays of every
    component: that of the smallest id. Different texts under one id are documents
    of their own here; rows equal in id and text are one. Rows without id stay."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row"))
    without, ids = ids.where("doc_id is null"), ids.where("doc_id is not null")
    often = stored(ids.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    n = often.count()
    if not n:
        kept = stored(near_duplicates(ids).where("kept").select("doc_id"), "kept")
        return texts_of(ids, kept, kept.count()).select("row.*").unionByName(without.select("row.*"))
    single = ids.join(F.broadcast(often) if n <= BROADCAST_IDS else often, "doc_id", "left_anti")
    repeated = (texts_of(ids, often, n).groupBy("doc_id", "text").agg(F.min_by("row", F.xxhash64("row")).alias("row")))
    low = min(0, ids.agg(F.min("doc_id")).first()[0])
    # numbers below all ids stand for the rows of repeated ids
    repeated = stored(repeated.withColumn("number", F.lit(low - 1) - F.monotonically_increasing_id()), "repeated")
    numbered = single.select("doc_id", "text").unionByName(repeated.select(F.col("number").alias("doc_id"), "text"))
    groups = near_duplicates(numbered).join(repeated.select("number", F.col("doc_id").alias("real")), F.col("doc_id") == F.col("number"), "left")
    kept = stored(groups.groupBy("component_id").agg(F.min(F.struct(F.coalesce("real", "doc_id").alias("real"), "doc_id")).alias("least"))
                  .select(F.col("least.doc_id").alias("doc_id")), "kept")
    m = kept.count()
    chosen = texts_of(single, kept, m).select("row.*")
    more = repeated.join(F.broadcast(kept) if m <= BROADCAST_IDS else kept, F.col("number") == kept["doc_id"], "left_semi").select("row.*")
    return chosen.unionByName(more).unionByName(without.select("row.*"))
