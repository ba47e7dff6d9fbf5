"""Silver CSV, Gold and History Parquet, views and output tables.

Every dataset is partitioned by its snapshot date and written with dynamic
partition overwrite, so rerunning one date replaces that date only (H5) and
nothing is rewritten whole. Reads always use the fixed schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.functions import tolerant_date
from immolens.schema import GOLD, GOLD_COLUMNS, SILVER

SILVER_DATE = "snapshot_date"
SILVER_ROWS_PER_FILE = 200_000
# Fixed value: the name of Gold files kept one per date.
TEXT_DATED_GOLD = "*_clean.parquet"


def _read_or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    """A layer that was never written reads as an empty table."""
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _partitioned_overwrite(df: DataFrame, partition_col: str, observation: Observation | None = None,
                           metrics: Sequence[Column] = ()):
    """Dynamic-overwrite writer partitioned by ``partition_col``.

    The rows are first rebalanced on the partition column (AQE's REBALANCE):
    each date lands in a few tasks instead of every task writing a small
    file for every date, a date holding most rows is split into several
    files, and small dates are merged. ``metrics`` are observed on the rows
    as they are written (after the exchange, in the tasks that write).
    """
    rows = df.hint("rebalance", partition_col)
    if observation is not None:
        rows = rows.observe(observation, *metrics)
    return (rows.write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic")
              .partitionBy(partition_col))


def write_silver(silver: DataFrame, path: str, date_col: str = SILVER_DATE,
                 rows_per_file: int = SILVER_ROWS_PER_FILE, compression: str = "none") -> None:
    """S3: CSV with header, quotes escaped by doubling, one folder per date.
    An empty input touches no date. A file holds at most ``rows_per_file``
    rows: fields may span lines, so a file is read by one task (S4), and
    ``compression`` ("gzip") costs no parallelism: readers know it by the
    files' ending."""
    (_partitioned_overwrite(silver.select(*SILVER.fieldNames(), date_col), date_col)
        .option("maxRecordsPerFile", rows_per_file).option("compression", compression).option("header", True).option("escape", '"').csv(path))


def read_silver(spark: SparkSession, path: str, snapshot_date: str | None = None) -> DataFrame:
    """Silver CSV with the fixed schema; quoted fields may span lines.

    ``escape='"'`` reads doubled quotes as one quote. A header line (with or
    without a byte-order mark) is skipped, columns are taken by position. A
    damaged record (a field that does not fit its type, too few or too many
    fields) fails the read.
    """
    schema = T.StructType(SILVER.fields + [T.StructField(SILVER_DATE, T.DateType())])
    df = _read_or_empty(spark, schema, lambda: (
        spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST")
        .option("multiLine", True).option("encoding", "UTF-8").csv(path)))
    if snapshot_date is not None:
        df = df.where(F.col(SILVER_DATE) == F.lit(snapshot_date).cast("date"))
    return df


def read_dated_silver_files(spark: SparkSession, pattern: str, default_date: str | None = None) -> DataFrame:
    """S4 + G7 for Silver kept one CSV per date (``<yyyy-MM-dd>.csv``, as
    written by pandas: BOM, doubled quotes, no position column): the
    snapshot date comes from each file's name, or is ``default_date`` where
    the name holds no date (without one, that raises); the position from the
    row's place in its file is unknown and left null."""
    schema = T.StructType([f for f in SILVER.fields if f.name != "position"])
    df = (spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST")
          .option("multiLine", True).option("encoding", "UTF-8").csv(pattern))
    name = F.col("_metadata.file_name")
    named = F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    other = (F.lit(default_date).cast("date") if default_date is not None
             else F.raise_error(F.concat(F.lit("no date in the file name "), name)).cast("date"))
    return df.select(
        *schema.fieldNames(),
        F.lit(None).cast("long").alias("position"),
        F.coalesce(named, other).alias(SILVER_DATE),
    )


def write_gold(gold: DataFrame, path: str) -> None:
    """Gold Parquet, one partition per snapshot date, dynamic overwrite."""
    _partitioned_overwrite(gold.select(*GOLD_COLUMNS), "date_scraping").parquet(path)


def read_gold(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """Every Gold snapshot under ``path``; no snapshot (no row) at all is
    an error unless ``required`` is False (then an empty table)."""
    df = _read_or_empty(spark, GOLD, lambda: spark.read.schema(GOLD).parquet(path))
    if required and df.isEmpty():                 # one-row job, no file list on the driver
        raise FileNotFoundError(f"no Gold snapshot under {path}")
    return df


def read_text_dated_gold_files(spark: SparkSession, pattern: str = TEXT_DATED_GOLD) -> DataFrame:
    """S6 + H2 for Gold kept one Parquet file per date with the date stored as
    text (``yyyy-MM-dd`` or ``dd-MM-yyyy``); no file at all is an error."""
    schema = T.StructType([f if f.name != "date_scraping" else T.StructField(f.name, T.StringType())
                           for f in GOLD.fields])
    try:
        df = spark.read.schema(schema).parquet(pattern)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no Gold file matches {pattern}") from exc
    if df.isEmpty():
        raise FileNotFoundError(f"no Gold file matches {pattern}")
    return df.withColumn("date_scraping", tolerant_date("date_scraping"))


def write_history(history: DataFrame, path: str, single_file: bool = False,
                  observation: Observation | None = None, metrics: Sequence[Column] = ()) -> None:
    """History Parquet partitioned by date. ``single_file`` is an opt-in
    export for small outputs (it funnels the data through one task). ``metrics``
    are observed while the rows are written and cost no scan."""
    if single_file:
        history.coalesce(1).write.mode("overwrite").parquet(path)
        return
    _partitioned_overwrite(history.select(*GOLD_COLUMNS), "date_scraping", observation, metrics).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History as written by ``write_history`` (empty if never written)."""
    return _read_or_empty(spark, GOLD, lambda: spark.read.schema(GOLD).parquet(path))


def register_history(spark: SparkSession, path: str, name: str = "listing_history",
                     external: bool = False) -> DataFrame:
    """Bind the history files to a name: a temp view, or an external
    (metastore) table over the same location."""
    if external:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in GOLD.fields)
        location = path.replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
                  f"PARTITIONED BY (date_scraping) LOCATION '{location}'")
        spark.catalog.recoverPartitions(name)
        return spark.table(name)
    df = read_history(spark, path)
    df.createOrReplaceTempView(name)
    return df


def bind_history_by_listing(spark: SparkSession, history: DataFrame, path: str, name: str = "listing_history_by_id",
                            buckets: int | None = None) -> DataFrame:
    """S8 for work per listing: the history as a table of ``path``, bucketed and
    sorted by listing id, so that grouping, deduplication and joins by listing
    need no exchange afterwards. One shuffle writes it (one file a bucket);
    ``buckets`` is the number of shuffle partitions unless given. All rows of a
    listing lie in one bucket: a table where one id holds a large share of the
    rows is better left to ``register_history``."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (history.select(*GOLD_COLUMNS).repartition(buckets, "id_annonce").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "id_annonce").sortBy("id_annonce").option("path", path).saveAsTable(name))
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A model materialised as a view (lazy, recomputed on use)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, path: str) -> None:
    """A model materialised as a table (full refresh)."""
    df.write.mode("overwrite").parquet(path)
