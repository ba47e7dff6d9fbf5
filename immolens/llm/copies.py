"""Rows that repeat an id and a text very often, for operators whose result is
the same for all of them: they are handled once and listed again at the end, so
that no task holds all of them. Nothing else changes places or is shuffled but
an id and a hash per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.llm.tables import stored

COPIES = 1000            # rows of one id and text that stay as they are
BROADCAST_KEYS = 500_000
_LISTED = 4096


def folded(docs: DataFrame, copies: int = COPIES) -> tuple[DataFrame, bool]:
    """``docs`` (with doc_id and text) and the column ``copies``: rows equal in
    all columns whose id and text occur more than ``copies`` times are one
    row that counts them, all others are as they were, with 1. And whether there are such
    rows."""
    of_text = F.xxhash64("text").alias("_hash")
    frequent = stored(docs.groupBy("doc_id", of_text).count().where(F.col("count") > copies).select(F.col("doc_id").alias("_id"), "_hash"), "frequent")
    n = frequent.count()
    if not n:
        return docs.withColumn("copies", F.lit(1).cast("long")), False
    keys = F.broadcast(frequent) if n <= BROADCAST_KEYS else frequent
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    often = rows.join(keys, same, "left_semi").drop("_text_hash").groupBy(*docs.columns).agg(F.count("*").alias("copies"))
    rest = rows.join(keys, same, "left_anti").drop("_text_hash").withColumn("copies", F.lit(1).cast("long"))
    return rest.unionByName(often), True


def unfolded(rows: DataFrame, repeated: bool) -> DataFrame:
    """Every row as often as its ``copies`` say, without that column. Long
    lists are dealt to tasks in blocks."""
    if not repeated:
        return rows.drop("copies")
    blocks = (rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _LISTED))))
              .withColumn("_listed", F.least(F.lit(_LISTED).cast("long"), F.col("copies") - F.col("_block") * _LISTED)).repartition("copies", "_block"))
    return blocks.withColumn("_one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_listed")))).select(*[c for c in rows.columns if c != "copies"])
