"""Market tables computed from the staging rows.

Every function takes the staging DataFrame and returns a DataFrame; column
names are arguments with the contract names as defaults. Means are rounded
once, after aggregation (``mean2``); inner means of A3 keep sixteen decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.functions import mean2, round2
from immolens.operators.bitmaps import seen_bits, seen_count, snapshot_words, with_ordinals
from immolens.operators.percentile import percentile
from immolens.sources.seed import typology_label_key


def price_evolution(stg: DataFrame, date_col: str = "date_scraping",
                    price_m2: str = "price_m2", price: str = "price_eur") -> DataFrame:
    """A1 + O1: per snapshot mean price per m², mean price and row count."""
    return (
        stg.groupBy(date_col)
        .agg(mean2(price_m2).alias("avg_price_m2"),
             mean2(price).alias("avg_price"),
             F.count(F.lit(1)).alias("nb_annonces"))
        .orderBy(F.col(date_col).asc_nulls_last())
    )


def typology(stg: DataFrame, rooms: str = "nb_pieces") -> DataFrame:
    """A2 + O1: per room count (null is its own group, sorted last)."""
    return (
        stg.groupBy(rooms)
        .agg(F.count(F.lit(1)).alias("nb_annonces"),
             mean2("price_m2").alias("avg_price_m2"),
             mean2("price_eur").alias("avg_rent"),
             mean2("surface_m2").alias("avg_surface"))
        .orderBy(F.col(rooms).asc_nulls_last())
    )


def typology_labelled(stg: DataFrame, seed: DataFrame, rooms: str = "nb_pieces",
                      open_ended_from: int = 5, max_seed_rows: int = 10_000) -> DataFrame:
    """A2 with the typology label of the reference table.

    The label join runs after the aggregation (one row per room count), so
    its input is tiny whatever the history size. Room counts at or above
    ``open_ended_from`` take that row's label ("5 and more"); null and 0 get
    no label. The seed is broadcast only when proven small (driver-side rows,
    or a count under ``max_seed_rows``), else shuffled.
    """
    return with_labels(typology(stg, rooms), seed, rooms, open_ended_from, max_seed_rows)


def with_labels(agg: DataFrame, seed: DataFrame, rooms: str = "nb_pieces",
                open_ended_from: int = 5, max_seed_rows: int = 10_000) -> DataFrame:
    """The label join of J2 over A2's rows."""
    labels = seed.select(F.col("nb_pieces").alias("_seed_rooms"), "label_typologie")
    # A table built from driver-side rows is bounded by construction; a
    # table read from files is counted (at most max_seed_rows + 1 rows).
    if labels.isLocal() or labels.limit(max_seed_rows + 1).count() <= max_seed_rows:
        labels = F.broadcast(labels)
    key = typology_label_key(F.col(rooms), open_ended_from)
    return (
        agg.join(labels, key == labels["_seed_rooms"], "left")
        .select(rooms, "label_typologie", "nb_annonces", "avg_price_m2", "avg_rent", "avg_surface")
        .orderBy(F.col(rooms).asc_nulls_last())
    )


def mean_of_snapshot_means(stg: DataFrame, city: str = "city",
                           date_col: str = "date_scraping") -> DataFrame:
    """A3 + O1: per city, the mean over snapshots of the per-snapshot means.

    Two aggregations; the first one is combined on the map side so a city
    holding most rows never reaches one task as raw rows.
    """
    def mean(c: str, kind: str):                       # sums of decimals: the same in any order
        return F.sum(F.col(c).cast(kind)) / F.count(c).cast("decimal(12,0)")

    daily = stg.groupBy(city, date_col).agg(
        mean("price_m2", "decimal(24,6)").alias("_p"), mean("surface_m2", "decimal(24,6)").alias("_s"))
    return (
        daily.groupBy(city)
        .agg(round2(mean("_p", "decimal(38,16)")).alias("avg_price_m2"),
             round2(mean("_s", "decimal(38,16)")).alias("avg_surface_m2"),
             F.count(F.lit(1)).alias("nb_weeks"))
        .orderBy(F.col("avg_price_m2").desc_nulls_last(), F.col(city).asc_nulls_last())
    )


def market_kpi(stg: DataFrame, date_col: str = "date_scraping") -> DataFrame:
    """A4: one row of global indicators (count 0 and nulls on empty input)."""
    return stg.agg(
        F.max(date_col).alias("last_scraping"),
        F.count(F.lit(1)).alias("total_annonces"),
        mean2("price_m2").alias("avg_price_m2"),
        round2(F.min("price_m2")).alias("min_price_m2"),
        round2(F.max("price_m2")).alias("max_price_m2"),
        mean2("surface_m2").alias("avg_surface"),
        mean2("price_eur").alias("avg_rent"),
    )


def price_cut(stg: DataFrame, p: float = 0.2, column: str = "price_m2",
              method: str = "exact", accuracy: int = 10000, alias: str = "p20") -> DataFrame:
    """A5: the p-th percentile of ``column`` over the whole history (one row)."""
    return percentile(stg, column, p, alias=alias, method=method, accuracy=accuracy)


BEST_DEAL_COLUMNS = ["id_annonce", "title", "city", "price_eur", "surface_m2",
                     "price_m2", "date_scraping", "description"]
# Cheapest first; ties by id, date, then the other columns.
DEAL_ORDER = ["price_m2", "id_annonce", "date_scraping", "price_eur", "surface_m2",
              "title", "city", "description"]


def best_deals(stg: DataFrame, p: float = 0.2, limit: int | None = 20,
               method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """J1 + O2: observations at or below the p-th percentile of price per m²,
    cheapest first, ties broken by id, date, then the other columns;
    ``limit=None`` keeps all.

    The percentile is a global aggregate, hence exactly one row: joining it
    as a broadcast is size-safe (BroadcastNestedLoopJoin with one row).
    """
    cut = price_cut(stg, p, method=method, accuracy=accuracy, alias="_cut")
    kept = (stg.crossJoin(F.broadcast(cut))
            .where(F.col("price_m2") <= F.col("_cut"))
            .select(*BEST_DEAL_COLUMNS))
    ordered = kept.orderBy(*[F.col(c).asc_nulls_last() for c in DEAL_ORDER])
    return ordered.limit(limit) if limit is not None else ordered


def listing_persistence(stg: DataFrame, id_col: str = "id_annonce", date_col: str = "date_scraping",
                        snapshots: Sequence | None = None) -> DataFrame:
    """A6 without its order. The snapshots in which a listing was seen are a
    bitmap over their ordinals, merged by OR and counted at the end: one
    exchange, by listing, where a distinct count would need two.

    ``snapshots`` is the ordered list of dates, if it is known (from the files
    of a partitioned history); else one narrow job finds it, one row a date.
    Like a distinct count, the bitmap leaves null dates out."""
    if snapshots is None:
        snapshots = sorted(r[0] for r in stg.select(date_col).distinct().collect() if r[0] is not None)
    words = snapshot_words(snapshots)
    return with_ordinals(stg, snapshots, date_col).groupBy(id_col).agg(
        F.min(date_col).alias("first_seen"),
        F.max(date_col).alias("last_seen"),
        *seen_bits(F.col("_ordinal"), words),
        mean2("price_m2").alias("avg_price_m2"),
        mean2("price_eur").alias("avg_rent"),
        mean2("surface_m2").alias("avg_surface"),
    ).select(id_col, "first_seen", "last_seen", seen_count(words).alias("nb_weeks_visible"),
             "avg_price_m2", "avg_rent", "avg_surface")


def persistence(stg: DataFrame, limit: int | None = None,
                id_col: str = "id_annonce", date_col: str = "date_scraping",
                snapshots: Sequence | None = None) -> DataFrame:
    """A6 (+ O3 when ``limit`` is set): per listing first and last snapshot,
    number of distinct snapshots and rounded means; most persistent first,
    ties by id.
    """
    listings = listing_persistence(stg, id_col, date_col, snapshots)
    out = listings.orderBy(F.col("nb_weeks_visible").desc(), F.col(id_col).asc_nulls_last())
    return out.limit(limit) if limit is not None else out
