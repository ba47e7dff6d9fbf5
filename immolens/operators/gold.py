"""Silver text rows -> typed Gold listings, unique per snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from immolens.functions import (
    CITY_PATTERN, DEFAULT_CITY, PRICE_PATTERN, ROOMS_PATTERN, SURFACE_PATTERN,
    collapse_newlines, extract_city, extract_fr_int, extract_int, is_http_url,
    listing_id, price_per_m2,
)
from immolens.schema import GOLD_COLUMNS


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row that sorts first on ``order``.

    ``row_number() = 1`` is planned with a WindowGroupLimit on both sides of
    the shuffle: each task sends on one row per key, so a key holding a third
    of all rows is cut before the shuffle, and every column travels once.
    ``order`` must be a total order inside a key for a deterministic winner
    (nulls sort first, as in ``ORDER BY ... ASC``).
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", first).where("_place = 1").select(*(columns or df.columns))


def _date_value(snapshot_date) -> Column:
    if isinstance(snapshot_date, Column):
        return snapshot_date.cast("date")
    if isinstance(snapshot_date, (dt.date, dt.datetime)):
        snapshot_date = snapshot_date.strftime("%Y-%m-%d")
    return F.lit(snapshot_date).cast("date")


def typed_listing_columns(number_style: str = "plain",
                          city_pattern: str = CITY_PATTERN,
                          default_city: str = DEFAULT_CITY) -> dict[str, Column]:
    """G1-G4 and G9-G10 as named expressions over Silver columns."""
    if number_style == "plain":
        price = extract_int("price", PRICE_PATTERN)
        surface = extract_int("details", SURFACE_PATTERN)
    elif number_style == "fr":
        price = extract_fr_int("price", "€")
        surface = extract_fr_int("details", "m²")
    else:
        raise ValueError(f"unknown number_style {number_style!r}")
    return {
        "price_eur": price,
        "surface_m2": surface,
        "nb_pieces": extract_int(F.lower("title"), ROOMS_PATTERN),
        "city": extract_city("details", city_pattern, default_city),
        "description": collapse_newlines("description"),
        "title": F.trim("title"),
    }


def to_gold(silver: DataFrame, snapshot_date, number_style: str = "plain",
            city_pattern: str = CITY_PATTERN, default_city: str = DEFAULT_CITY,
            order: Sequence[str] = ("source_file", "position"),
            dedupe: bool = True) -> DataFrame:
    """Silver -> Gold.

    ``snapshot_date`` is a date, a ``yyyy-MM-dd`` string or a Column (a
    backfill of many snapshots in one job). All expressions go into one
    projection; the URL filter sits before the dedupe shuffle; the dedupe
    keeps the first row per (snapshot, id) by ``order``.
    """
    typed = typed_listing_columns(number_style, city_pattern, default_city)
    staged = (silver
              .where(is_http_url("url"))                                   # G5
              .withColumns(typed)                                          # G1-G4, G9, G10
              .withColumn("id_annonce", listing_id("url"))                 # G6
              .withColumn("date_scraping", _date_value(snapshot_date))     # G7
              .withColumn("price_m2", price_per_m2("price_eur", "surface_m2")))  # G8
    extra = [c for c in order if c not in GOLD_COLUMNS]
    projected = staged.select(*GOLD_COLUMNS, *extra)                       # G11
    if not dedupe:
        return projected.select(*GOLD_COLUMNS)
    # rows without a position are told apart by their values (a hash first: cheap to compare)
    tie_break = [F.xxhash64(*GOLD_COLUMNS), "title", "price_eur", "url"]
    return dedupe_first(projected, ["date_scraping", "id_annonce"], [*order, *tie_break],
                        GOLD_COLUMNS)                                      # G12
