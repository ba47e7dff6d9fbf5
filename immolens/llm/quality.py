"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

1. One pass over the texts computes ``STATS`` document statistics (lengths,
   symbol shares, repetition of words, shingles and lines, entropy). They are
   stored; the texts are not read again.
2. Standardised statistics x become ``FEATURES`` random Fourier features
   ``sqrt(2/D) cos(Wx + b)``, whose inner products approximate a Gaussian
   kernel.
3. Ridge regression on the labelled rows: every partition sums its normal
   equations, the sums are added up row by row of the matrix, and the result
   (``FEATURES`` squared, whatever the table's size) is solved on the driver.
4. Isotonic regression maps the regression's value to a probability, fitted
   on labelled rows kept out of step 3: a sample of at most about
   ``MAX_CALIBRATION`` rows, taken by a hash.

Cases: a null text counts as empty; its statistics are zeros and it gets a
score like any other. Very long texts are processed whole. Repeated rows get
equal scores. Rows without a label, or whose id is null, are scored but
teach nothing; a document labelled more than once teaches its lowest label.
Without usable labels, or with one class only, every score is that class's
share (0.5 without labels). An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.hashing import run_hashes
from immolens.llm.memory import thrifty
from immolens.llm.tables import stored
from immolens.llm.words import CHUNK_BYTES, _chunk, shingle_hashes, text_buffer

FEATURES = 256
RIDGE = 1e-3
THRESHOLD = 0.7
MAX_CALIBRATION = 20_000
SEED = 20240611

# Byte classes; their shares are statistics.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:",
            b"!?", b"#$%&*@~^", b"|<>{}[]()=\\/_`", b"'\"-+", bytes(range(128, 256))]
_CLASS = np.full(256, len(_CLASSES), dtype=np.int64)
for _k, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _k
N_CLASSES = len(_CLASSES) + 1
STATS = N_CLASSES + 18
BANDWIDTH = (2 * STATS) ** 0.5  # of the Gaussian kernel: the usual distance of two rows of standardised statistics


def _distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct keys, and how often the commonest one occurs."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(k)))
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, r[first], counts)
    return np.bincount(r[first], minlength=n), most


def document_stats(column: pa.Array) -> np.ndarray:
    """One row of ``STATS`` float32 statistics per text."""
    data, offsets = text_buffer(column)
    out = np.zeros((len(offsets) - 1, STATS), dtype=np.float32)
    a = 0
    while a < len(out):
        b = int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1
        b = min(max(b, a + 1), len(out))
        out[a:b] = _stats(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        a = b
    return out


def _stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    some = np.maximum(size, 1)
    words = _chunk(data, offsets, 0)
    count = np.diff(words.bounds)
    w = np.maximum(count, 1)
    word_doc = np.repeat(np.arange(n), count)
    starts = words.starts + offsets[word_doc]
    ends = words.ends + offsets[word_doc]
    classes = np.bincount(doc * N_CLASSES + _CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    bytes_ = np.bincount(doc * 256 + data, minlength=n * 256).reshape(n, 256)
    p = bytes_ / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(word_doc, weights=flags, minlength=n) / w

    upper = np.concatenate([[0], np.cumsum(_CLASS[data] == 0)])
    lower = np.concatenate([[0], np.cumsum(_CLASS[data] == 1)])
    capitals, smalls = upper[ends] - upper[starts], lower[ends] - lower[starts]
    last = _CLASS[data[np.maximum(ends - 1, 0)]] if len(ends) else np.zeros(0, dtype=np.int64)
    initial = _CLASS[data[starts]] if len(starts) else np.zeros(0, dtype=np.int64)
    length = ends - starts
    distinct_words, commonest_word = _distinct(words.hashes, word_doc, n)
    repeat = np.zeros(len(word_doc), dtype=bool)
    repeat[1:] = (words.hashes[1:] == words.hashes[:-1]) & (word_doc[1:] == word_doc[:-1])

    grams = shingle_hashes(words.hashes)
    inside = word_doc[:len(grams)] == word_doc[len(word_doc) - len(grams):] if len(grams) else np.zeros(0, dtype=bool)
    gram_doc = word_doc[:len(grams)][inside]
    gram_count = np.maximum(np.bincount(gram_doc, minlength=n), 1)
    distinct_grams, _ = _distinct(grams[inside], gram_doc, n)

    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets[:-1]] = True
    edge[1:] |= np.append(data == 10, False)[:-1] if len(data) else False
    line_starts = np.flatnonzero(edge[:-1])
    line_ends = np.append(line_starts[1:], len(data))
    full = line_ends > line_starts
    line_starts, line_ends = line_starts[full], line_ends[full]
    stop = line_ends - (data[np.maximum(line_ends - 1, 0)] == 10) if len(line_ends) else line_ends
    line_doc = doc[line_starts] if len(line_starts) else np.zeros(0, dtype=np.int64)
    line_count = np.bincount(line_doc, minlength=n)
    distinct_lines, commonest_line = _distinct(run_hashes(data, line_starts, stop), line_doc, n)
    longest = np.zeros(n)
    np.maximum.at(longest, line_doc, stop - line_starts)
    lines = np.maximum(line_count, 1)
    periods = np.bincount(doc[data == 46], minlength=n)

    mean = share(length)
    stats = [np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(share(length.astype(float) ** 2) - mean ** 2, 0)),
             np.where(count, distinct_words / w, 0), np.where(count, commonest_word / w, 0), share(repeat),
             np.where(gram_count > 0, distinct_grams / gram_count, 0), share((capitals >= 2) & (smalls == 0)), share(initial == 0),
             share((last == 5) | (last == 6)), share(length == 1), np.log1p(line_count),
             np.where(line_count, distinct_lines / lines, 0), np.where(line_count, commonest_line / lines, 0), np.log1p(longest),
             np.log1p(count / (periods + 1)), entropy]
    return np.column_stack([*stats, classes / some[:, None]]).astype(np.float32)


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<float>) of every row."""
    @thrifty
    def compute(batches):
        for batch in batches:
            stats = document_stats(batch.column(1))
            flat = pa.array(stats.ravel(), pa.float32())
            ends = pa.array(np.arange(0, stats.size + 1, STATS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "stats"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(compute, "doc_id long, stats array<float>"))


def _rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATS).astype(np.float64)


class FourierFeatures:
    def __init__(self, mean: np.ndarray, deviation: np.ndarray, size: int = FEATURES):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.normal(0, 1 / BANDWIDTH, (len(mean), size))
        self.b = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.deviation, -8, 8)
        z = np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)
        return np.column_stack([z, np.ones(len(z))])


def normal_equations(rows: DataFrame, features: FourierFeatures) -> tuple[np.ndarray, np.ndarray]:
    """``Z'Z`` and ``Z'y`` of ``rows`` (stats, label): summed per partition,
    then per row of the matrix."""
    size = len(features.b) + 1

    @thrifty
    def partial(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = features(_rows_of(batch.column(0)))
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "part"])

    def add(key, table):
        total = np.zeros(size + 1)
        for part in table.column("part").to_pylist():
            total += np.frombuffer(part)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    schema = "i int, part binary"
    summed = rows.select("stats", "label").mapInArrow(partial, schema).groupBy("i").applyInArrow(add, schema)
    matrix = np.zeros((size, size + 1))
    for i, part in summed.collect():                     # `size` rows, whatever the table's size
        matrix[i] = np.frombuffer(part)
    return matrix[:, :-1], matrix[:, -1]


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: block centres (ascending), the blocks' means
    and their least values."""
    order = np.argsort(values, kind="stable")
    blocks: list[list[float]] = []                       # [sum of labels, weight, sum of values, least value]
    for v, y in zip(values[order], labels[order]):
        blocks.append([y, 1.0, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y1, w1, v1, _ = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y1, blocks[-1][1] + w1, blocks[-1][2] + v1, blocks[-1][3]]
    at = np.array([b[2] / b[1] for b in blocks])
    return at, np.array([b[0] / b[1] for b in blocks]), np.array([b[3] for b in blocks])


class QualityModel:
    """Scores from statistics; small enough for a task's closure."""

    def __init__(self, features=None, weights=None, at=None, means=None, constant: float = 0.5):
        self.features, self.weights, self.at, self.means, self.constant = features, weights, at, means, constant

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(stats), self.constant)
        return np.interp(self.raw(stats), self.at, self.means)


def fit(stats: DataFrame, labels: DataFrame, calibrates: Column, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """``stats``: (doc_id, stats) of the rows that may teach; ``labels``: 0/1 by id.
    Rows of ``calibrates`` (a condition on doc_id) fit the calibration."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label")))
    rows = stored(stats.join(known, "doc_id").select("doc_id", "stats", "label", calibrates.alias("calibrates")), "labelled")
    n, ones, held, held_ones = rows.agg(F.count("*"), F.sum("label"), F.count_if("calibrates"), F.sum(F.col("label") * F.col("calibrates").cast("int"))).first()
    if not n or ones in (0, n):
        return QualityModel(constant=ones / n if n else 0.5)
    moments = rows.agg(*[f(F.col("stats")[k]) for k in range(STATS) for f in (F.avg, F.stddev_pop)]).first()
    features = FourierFeatures(np.array(moments[0::2], dtype=float), np.array(moments[1::2], dtype=float))
    separate = 0 < held_ones < held and 0 < ones - held_ones < n - held      # else too few rows: calibrate on all
    zz, zy = normal_equations(rows.where("not calibrates") if separate else rows, features)
    weights = np.linalg.solve(zz + RIDGE * n * np.eye(len(zz)) / len(zz), zy)
    model = QualityModel(features, weights)
    pool = rows.where("calibrates") if separate else rows
    share = min(1.0, MAX_CALIBRATION / (held if separate else n))
    sample = pool.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).select("stats", "label").toArrow()
    values, y = model.raw(_rows_of(sample.column(0).combine_chunks())), sample.column(1).to_numpy().astype(float)
    model.at, model.means = isotonic(values, y)[:2] if len(y) else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def scored(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""
    @thrifty
    def score(batches):
        for batch in batches:
            values = model(_rows_of(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(values, 0, 1), pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(score, "doc_id long, score double")


def id_remainder(divisor: int) -> Column:
    """crc32 of the id as text, by ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor, F.lit(-1))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Rows with
    remainder 2 (of 4) are held out, those with remainder 3 calibrate."""
    stats = stored(with_stats(docs, id_col, text_col), "stats")
    model = fit(stats.where(id_remainder(4) != 2), labels, id_remainder(4) == 3)
    return (scored(stats, model).withColumn("held_out", id_remainder(4) == 2)
            .select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def accepted_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score reaches the
    threshold. Only the statistics of labelled rows are stored for the fit;
    the others' are computed where the rows are, and no text is shuffled."""
    named = labels.where("quality in (0, 1)").select(F.col(id_col).alias("doc_id")).distinct()
    stats = with_stats(docs, id_col, text_col)
    model = fit(stats.where(id_remainder(4) != 2).join(named, "doc_id", "left_semi"), labels, id_remainder(4) == 3)
    at = docs.columns.index(text_col)

    @thrifty
    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                score = np.clip(model(document_stats(batch.column(at)).astype(np.float64)), 0, 1)
                yield batch.filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
