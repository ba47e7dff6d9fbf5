"""Raw result pages stored as ``<root>/<yyyy-MM-dd>/page_<N>.html``."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.operators.cutoff import cut_at_first
from immolens.schema import RAW_PAGE

# Text that marks the page after the last result page. A digit
# before "0 annonce" makes it a count such as "10 annonces", not the marker.
# It begins with a plain text, which a search finds quickly.
END_OF_RESULTS_PATTERN = r" annonce(?:(?<=Aucune annonce)|(?<=0 annonce)(?<![0-9]0 annonce))"
MAX_USER_AGENT_CHARS = 250

PAGE_METADATA = T.StructType([
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
])


def decode_utf8(content) -> F.Column:
    """Bytes -> text, dropping invalid byte sequences."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def days_between(first: str | dt.date, last: str | dt.date) -> list[str]:
    """All days of a range, both ends included, as yyyy-MM-dd."""
    first, last = (dt.date.fromisoformat(str(d)) for d in (first, last))
    return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def read_pages(spark: SparkSession, root: str, snapshot_date: str | tuple[str, str] | None = None,
               metadata: DataFrame | None = None) -> DataFrame:
    """S1 (+ S2): raw pages of one date, of a range of dates (first, last) or
    of every date as a DataFrame. Only the folders asked for are listed.

    Date and page number come from the path; the metadata table, when
    given, is joined on (snapshot_date, page_no). No page -> empty result.
    A folder whose name is not a date of the calendar is left out.
    """
    date_glob = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"   # only yyyy-MM-dd folders
    if isinstance(snapshot_date, tuple):
        date_glob = "{" + ",".join(days_between(*snapshot_date)) + "}"
    pattern = f"{root.rstrip('/')}/{snapshot_date if isinstance(snapshot_date, str) else date_glob}"
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.html")
                 .load(pattern).select("path", "content"))
    except AnalysisException as exc:  # nothing written for that date yet
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_PAGE)
    pages = files.select(
        F.try_to_date(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)).alias("snapshot_date"),
        F.regexp_extract("path", r"page_(\d+)\.html$", 1).try_cast("bigint").alias("page_no"),
        decode_utf8(F.col("content")).alias("html"),
        F.col("path").alias("source_file"),
    ).where(F.col("snapshot_date").isNotNull())
    return _with_metadata(pages, metadata)


def write_page_table(pages: DataFrame, path: str) -> None:
    """Pages as the table that ``read_page_table`` reads; the dates in
    ``pages`` are replaced. Markup repeats itself: zstd takes a fraction of
    the space."""
    (pages.select("page_no", "html", "source_file", "snapshot_date").hint("rebalance", "snapshot_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("snapshot_date").parquet(path))


def read_page_table(spark: SparkSession, path: str, snapshot_date: str | tuple[str, str] | None = None,
                    metadata: DataFrame | None = None) -> DataFrame:
    """S1 for pages kept as a Parquet table partitioned by ``snapshot_date``
    (page_no, html, source_file): for large backfills, as no task or driver
    has to list one file per page. A date or a range (first, last) prunes
    folders."""
    schema = T.StructType([f for f in RAW_PAGE.fields if f.name in ("snapshot_date", "page_no", "html", "source_file")])
    pages = spark.read.schema(schema).parquet(path)
    if snapshot_date is not None:
        first, last = snapshot_date if isinstance(snapshot_date, tuple) else (snapshot_date, snapshot_date)
        pages = pages.where(F.col("snapshot_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return _with_metadata(pages, metadata)


def _with_metadata(pages: DataFrame, metadata: DataFrame | None) -> DataFrame:
    if metadata is None:
        return pages.select(
            "snapshot_date", "page_no", "html",
            F.lit(None).cast("string").alias("source_url"),
            F.lit(None).cast("timestamp").alias("scraped_at"),
            F.lit(None).cast("string").alias("user_agent"),
            F.lit(None).cast("int").alias("status_code"),
            "source_file")
    meta = metadata.select(
        "snapshot_date", "page_no", "source_url", "scraped_at",
        F.substring("user_agent", 1, MAX_USER_AGENT_CHARS).alias("user_agent"), "status_code")
    return pages.join(meta, ["snapshot_date", "page_no"], "left").select(*RAW_PAGE.fieldNames())


def read_page_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Page metadata stored as JSON lines next to the pages."""
    return spark.read.schema(PAGE_METADATA).json(path)


def take_until_end(pages: DataFrame, end_pattern: str = END_OF_RESULTS_PATTERN,
                   date_col: str = "snapshot_date", page_col: str = "page_no",
                   html_col: str = "html", status_col: str = "status_code") -> DataFrame:
    """Per date, pages in page-number order up to and including the
    first page showing the end-of-results text, and strictly before the
    first page with an HTTP status of 400 or more. A page without a number
    (a file not named ``page_<n>.html``) has no place in that order: it is
    kept, unless its status is 400 or more, and ends nothing."""
    return cut_pages(
        pages, F.col(html_col).rlike(end_pattern), date_col, page_col, status_col)


def cut_pages(pages: DataFrame, ends: F.Column, date_col: str = "snapshot_date",
              page_col: str = "page_no", status_col: str = "status_code") -> DataFrame:
    """S12 with the end-of-results condition given as a column."""
    numbered = F.col(page_col).isNotNull()
    failed = F.coalesce(F.col(status_col) >= 400, F.lit(False))
    return cut_at_first(
        pages, [date_col], [page_col],
        stop_after=numbered & F.coalesce(ends, F.lit(False)),
        stop_before=numbered & failed,
        few_groups=True,
    ).where(numbered | ~failed)
