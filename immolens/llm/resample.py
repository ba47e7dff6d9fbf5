"""Operator 13: resampling documents towards a target distribution.

Words (runs of digits, a-z and everything beyond ASCII; A-Z lower-cased) give
the features: all runs of one to three words, hashed to ``BUCKETS`` buckets.
The corpus and the target table are counted per bucket; a bucket's gain is
the logarithm of the two smoothed shares' ratio. A document's weight is the
sum of its features' gains; Gumbel noise from its id turns the weights of a
draw without replacement into a plain ranking.

Each pass interns the n-grams of a batch in an open-addressed table
(``ngrams``): the bucket is found once per distinct n-gram, the counts are
added up per slot, and the occurrences' slot ids gather the gains. The counts
of all buckets (a fixed number of rows) are all that reaches the driver; the
scores are written once, and only rows that can be drawn are sorted.

Results that are defined here: a null or empty text has no words (weight 0,
never drawn); rows with fewer than ``min_words`` words are scored and never
drawn; ties go to the smaller id, a null id comes last; rows that share an id
share the noise and are ranked one by one; empty tables give empty results, an
empty target gains from smoothing alone. Of the input only the id and the
columns in ``carry`` are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from immolens.llm.memory import give_back, thrifty
from immolens.llm.ngrams import ngram_blocks
from immolens.llm.tables import stored

BUCKETS = 10_000
ORDERS = range(1, 4)
MIN_WORDS = 20
ACCURACY = 10_000               # of the sketch that bounds the rows to be sorted

_COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_SCORES = "n_words bigint, n_features bigint, weight bigint"


@thrifty
def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, _, blocks in ngram_blocks(batch.column(0), ORDERS, BUCKETS):
            for block in blocks:
                np.add.at(counts, block.table.bucket, block.table.count)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], schema=_COUNTED)


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Occurrences of features per bucket over a whole table (at most
    ``BUCKETS`` rows reach the driver)."""
    found = (texts.select(F.col(text_col).alias("text")).mapInArrow(_count_batches, "bucket int, n bigint")
             .groupBy("bucket").agg(F.sum("n").alias("n")))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in found.collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the target's smoothed share over the source's."""
    whole, aimed = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (whole + BUCKETS) / ((s + 1.0) * (aimed + BUCKETS))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def feature_scores(gains: np.ndarray, text: Column | str) -> Column:
    """A struct per text: words, features, and the sum of the features' gains."""
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for column in batches:
                words, features, weight = (np.zeros(len(column), dtype=np.int64) for _ in range(3))
                for first, n_words, blocks in ngram_blocks(column, ORDERS, BUCKETS):
                    at = slice(first, first + len(n_words))
                    words[at] = n_words
                    features[at] = sum(np.maximum(n_words - (n - 1), 0) for n in ORDERS)
                    for block in blocks:
                        gathered = gains[block.table.bucket][block.table.slot_ids]
                        np.add.at(weight, first + block.rows, gathered)
                yield pa.StructArray.from_arrays([pa.array(x) for x in (words, features, weight)],
                                                 names=["n_words", "n_features", "weight"])
        finally:
            give_back()
    return F.arrow_udf(score, f"struct<{_SCORES.replace(' bigint', ':bigint')}>")(text)


def gumbel_noise(seed: int, doc_id: Column | str) -> Column:
    """floor(-1000 ln(-ln u)); u comes from the first 32 bits of
    sha256("<seed>:<id>")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str)
                                                 else doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def ranked(scored: DataFrame, id_col: str, drawn: int, total: int) -> DataFrame:
    """``scored`` (id, score, eligible, ...) with the ``rank`` of the ``drawn``
    highest eligible scores of ``total``, null elsewhere.

    A quantile sketch bounds from below the scores that can be drawn; only
    those rows are sorted, in ranges, and numbered by range."""
    if drawn == 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    share = max(0.0, 1 - drawn / total - 2 / ACCURACY)
    able = scored.where("eligible")
    floor = able.agg(F.percentile_approx("score", share, ACCURACY)).first()[0]
    if able.where(F.col("score") >= floor).count() < drawn:      # the sketch promises otherwise
        floor = able.agg(F.min("score")).first()[0]
    can = F.col("eligible") & (F.col("score") >= F.lit(floor))
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    ranges = stored(scored.where(can).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))    # one row a range
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    top = (ranges.join(F.broadcast(offsets), "_range").withColumn("rank", place.cast("long")).drop("_range", "_before")
           .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))))
    rest = scored.where(~F.coalesce(can, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return rest.unionByName(top)


def importance_resample(docs: DataFrame, target: DataFrame, per_hundred: int = 5, seed: int = 42, min_words: int = MIN_WORDS,
                        id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
                        carry: Sequence[str] = ()) -> DataFrame:
    """(id, carried columns, n_features, weight, score, rank) of every row;
    ``rank`` numbers the floor(per_hundred * N / 100) rows drawn of the N with
    at least ``min_words`` words."""
    clash = {"n_features", "weight", "score", "rank", "eligible"} & {id_col, *carry}
    if clash:
        raise ValueError(f"columns cannot be carried under the names of results: {sorted(clash)}")
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    keep = [id_col, *carry]
    found = docs.select(*keep, feature_scores(gains, F.col(text_col)).alias("_f"))
    scored = stored(found.select(*keep, F.col("_f.n_features").alias("n_features"), F.col("_f.weight").alias("weight"),
                                 (F.col("_f.weight") + gumbel_noise(seed, id_col)).alias("score"),
                                 (F.col("_f.n_words") >= min_words).alias("eligible")), "scores")
    total = scored.where("eligible").count()
    return ranked(scored, id_col, per_hundred * total // 100, total).select(*keep, "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows, with the texts if they are carried, best first by rank."""
    return importance_resample(docs, target, **options).where(F.col("rank").isNotNull())
