"""The snapshots in which a listing occurs, as a bitmap.

Snapshots are numbered in order of their dates; a group's bitmap is one long
per 64 of them. Partial bitmaps merge by OR, so a distinct count of snapshots
is one aggregation (and one exchange) like a sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64                       # snapshots per bitmap word


def snapshot_words(snapshots: Sequence) -> int:
    return max(1, -(-len(snapshots) // WORD))


def seen_bits(ordinal: Column, words: int) -> list[Column]:
    """Aggregates: a bitmap of the snapshots in which a group occurs, one
    long per 64 of them; states merge by OR."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (ordinal % WORD).cast("int"))
    return [F.bit_or(F.when(F.floor(ordinal / WORD) == i, bit)).alias(f"_seen_{i}") for i in range(words)]


def seen_count(words: int) -> Column:
    return sum((F.coalesce(F.bit_count(f"_seen_{i}"), F.lit(0)) for i in range(words)), F.lit(0)).cast("long")


def with_ordinals(df: DataFrame, snapshots: Sequence, date_col: str = "date_scraping") -> DataFrame:
    """``df`` with ``_ordinal``, the place of its date in ``snapshots`` (null
    for a null date). The list has one row per snapshot: a broadcast join."""
    places = df.sparkSession.createDataFrame([(d, i) for i, d in enumerate(snapshots)], "_day date, _ordinal long")
    return df.join(F.broadcast(places), F.col(date_col) == F.col("_day"), "left").drop("_day")
