"""H1-H4: the listing history (every snapshot row kept) and its statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.functions import tolerant_date
from immolens.schema import HISTORY_COLUMNS


def normalize_snapshot_date(df: DataFrame, date_col: str = "date_scraping") -> DataFrame:
    """H2: text dates become dates (``yyyy-MM-dd`` then ``dd-MM-yyyy``)."""
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, T.DateType):
        return df
    if isinstance(dtype, T.StringType):
        return df.withColumn(date_col, tolerant_date(date_col))
    return df.withColumn(date_col, F.col(date_col).cast("date"))


def union_snapshots(*snapshots: DataFrame) -> DataFrame:
    """H1: UNION ALL of Gold snapshots by name; duplicates are kept."""
    if not snapshots:
        raise ValueError("no snapshot to historise")
    frames = [normalize_snapshot_date(s).select(*HISTORY_COLUMNS) for s in snapshots]
    return reduce(lambda a, b: a.unionByName(b), frames)


def history_stats(history: DataFrame, id_col: str = "id_annonce",
                  date_col: str = "date_scraping") -> DataFrame:
    """H3: rows, distinct ids and distinct dates in one pass.

    A null counts as one more distinct value, as with ``distinct().count()``.
    """
    def distinct_with_null(c: str):
        return F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))

    return history.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(distinct_with_null(id_col), F.lit(0)).cast("long").alias("distinct_ids"),
        F.coalesce(distinct_with_null(date_col), F.lit(0)).cast("long").alias("distinct_dates"),
    )


def rows_per_snapshot(history: DataFrame, date_col: str = "date_scraping") -> DataFrame:
    """H4: number of rows of each snapshot, by date."""
    return (history.groupBy(date_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col(date_col).asc_nulls_first()))
