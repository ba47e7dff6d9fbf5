"""Fixed schemas of every layer and the default column names of the contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw page table: one row per fetched result page.
RAW_PAGE = T.StructType([
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("html", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
])

# Silver: text extracted from the pages, all strings (+ link ordinal).
SILVER = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("position", T.LongType()),
])
SILVER_COLUMNS = [f.name for f in SILVER.fields]

# Gold: typed listing, unique on id_annonce inside one snapshot.
GOLD = T.StructType([
    T.StructField("id_annonce", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price_eur", T.IntegerType()),
    T.StructField("surface_m2", T.IntegerType()),
    T.StructField("nb_pieces", T.IntegerType()),
    T.StructField("price_m2", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("date_scraping", T.DateType()),
])
GOLD_COLUMNS = [f.name for f in GOLD.fields]

# History has the Gold schema; every snapshot row is kept.
HISTORY = GOLD
HISTORY_COLUMNS = GOLD_COLUMNS

# Staging view (url dropped, amounts as double).
STAGING = T.StructType([
    T.StructField("id_annonce", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price_eur", T.DoubleType()),
    T.StructField("surface_m2", T.DoubleType()),
    T.StructField("nb_pieces", T.IntegerType()),
    T.StructField("price_m2", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("date_scraping", T.DateType()),
])
STAGING_COLUMNS = [f.name for f in STAGING.fields]

# Room-count reference table.
SEED_TYPOLOGY = T.StructType([
    T.StructField("nb_pieces", T.IntegerType()),
    T.StructField("label_typologie", T.StringType()),
    T.StructField("description", T.StringType()),
])

# Default snapshot partition column.
DATE_COL = "date_scraping"
ID_COL = "id_annonce"
