"""Q3, H4: what is known of a partitioned history without reading its rows.

Parquet footers hold the number of rows and the partition folders the date, so
Spark answers a count per partition from the footers alone (aggregate
pushdown). The pushdown belongs to the second version of the file sources; it
is switched on in a session of its own, the caller's settings stay as they are.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from immolens.operators.quality import freshness, snapshot_loaded_at
from immolens.sources.files import read_history

DATE = "date_scraping"
_PARTITION = re.compile(rf"/{DATE}=([^/]+)/[^/]*$")


def snapshot_counts(spark: SparkSession, path: str) -> DataFrame:
    """(date_scraping, rows) of a history, from the footers of its files."""
    reading = spark.newSession()
    reading.conf.set("spark.sql.sources.useV1SourceList", "")
    reading.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return read_history(reading, path).groupBy(DATE).agg(F.count(F.lit(1)).alias("rows"))


def snapshot_sizes(spark: SparkSession, path: str) -> dict[dt.date | None, int]:
    """Rows per snapshot (one entry per snapshot reaches the driver)."""
    return {r[DATE]: r["rows"] for r in snapshot_counts(spark, path).collect()}


def freshness_of_files(spark: SparkSession, path: str, as_of, warn_after_hours: float = 48,
                       error_after_hours: float = 96) -> DataFrame:
    """Q3 of a partitioned history, from its footers: no column is read."""
    dates = spark.createDataFrame([(d,) for d in snapshot_sizes(spark, path)], f"{DATE} date")
    return freshness(dates, snapshot_loaded_at(DATE), as_of, warn_after_hours, error_after_hours)


def snapshot_files(history: DataFrame) -> dict[dt.date | None, list[str]]:
    """The data files of every snapshot of a history that was read from files,
    by the listing that Spark keeps for it. A rewritten snapshot has files of
    other names."""
    found: dict[dt.date | None, list[str]] = {}
    for file in history.inputFiles():
        text = unquote(_PARTITION.search(file).group(1))
        date = None if text == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(text)
        found.setdefault(date, []).append(file.rsplit("/", 1)[1])
    return found
