"""Mergeable states of the history, and the market tables rolled up from them.

One scan of the History gives the *market states*: per (snapshot, city, rooms)
the added-up amounts, counts, extremes and failed checks. Every market mean,
the indicators and the check report are sums over these few rows, so the
tables A1-A4 and Q1, Q2 cost one scan together. Three more kinds of states
complete the refresh: rows per price (for the percentile), the cheapest rows
of a snapshot (for the best deals) and sums per listing (for persistence).

All states belong to one snapshot each and can be merged in any order: a
snapshot's states are replaced when it is loaded again, and nothing else is
read. Sums are exact (whole cents), so merged results equal direct ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from immolens.functions import amount_parts, mean_of_parts, round2
from immolens.operators.bitmaps import seen_bits, seen_count, snapshot_words, with_ordinals
from immolens.operators.marts import BEST_DEAL_COLUMNS, DEAL_ORDER, with_labels
from immolens.operators.percentile import find_weighted_percentile
from immolens.operators.quality import SOURCE_CHECKS, STAGING_CHECKS, Check
from immolens.operators.staging import is_staged, staging_columns, to_staging

DATE, CITY, ROOMS, ID = "date_scraping", "city", "nb_pieces", "id_annonce"
AMOUNTS = ("price_m2", "price_eur", "surface_m2")
TOP_ROWS = 20                   # cheapest rows kept per snapshot


def _amounts(condition: Column | None = None) -> list[Column]:
    parts = []
    for a in AMOUNTS:
        value = F.col(a) if condition is None else F.when(condition, F.col(a))
        parts += [c.alias(f"{a}_{k}") for k, c in amount_parts(value).items()]
    return parts


def _merged_amounts() -> list[Column]:
    """The parts of states added up again (cents as decimals: many states may
    hold more than a long)."""
    return [c for a in AMOUNTS for c in (
        _long_sum(f"{a}_cents").alias(f"{a}_cents"), F.sum(f"{a}_rest").alias(f"{a}_rest"), F.sum(f"{a}_n").alias(f"{a}_n"))]


def _long_sum(c: str) -> Column:
    """The exact sum of longs, as a decimal. The upper and the lower 32 bits
    are added up apart, as longs: a sum of decimals makes objects for every row."""
    upper, lower = F.sum(F.shiftright(c, 32)), F.sum(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (upper.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + lower.cast("decimal(20,0)")).cast("decimal(38,0)")


def _mean(amount: str) -> Column:
    return mean_of_parts(*(F.col(f"{amount}_{k}") for k in ("cents", "rest", "n")))


# ------------------------------------------------------------- states ----

def market_states(history: DataFrame) -> DataFrame:
    """One row per (snapshot, city, rooms): ``rows`` of the History, staged
    rows ``n``, parts of the amounts, price extremes, failures per check."""
    staged = F.col("_staged")
    rows = history.select(*staging_columns(history, (ID, "price_eur", "surface_m2", ROOMS, "price_m2", CITY, DATE)),
                          F.coalesce(is_staged(), F.lit(False)).alias("_staged"))
    return rows.groupBy(DATE, CITY, ROOMS).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(staged).alias("n"), *_amounts(staged),
        F.min(F.when(staged, F.col("price_m2"))).alias("price_m2_min"), F.max(F.when(staged, F.col("price_m2"))).alias("price_m2_max"),
        *[chk.failures(staged).alias(f"staging_{i}") for i, chk in enumerate(STAGING_CHECKS)],
        *[chk.failures().alias(f"source_{i}") for i, chk in enumerate(SOURCE_CHECKS)])


def price_states(history: DataFrame) -> DataFrame:
    """Staged rows per (snapshot, price per m²)."""
    return to_staging(history).where(F.col("price_m2").isNotNull()).groupBy(DATE, "price_m2").agg(F.count(F.lit(1)).alias("n"))


def deal_states(history: DataFrame, top: int = TOP_ROWS) -> DataFrame:
    """The ``top`` cheapest staged rows of every snapshot (a group limit on
    both sides of the shuffle: few rows a task and snapshot travel).

    Rows above a price that ``top`` rows do not exceed are left out before the
    sort: a snapshot's prices are dealt into ``8 * top`` buckets, and the
    ``top``-th lowest of the buckets' minima is such a price. A snapshot with fewer
    buckets has none, and all its rows are sorted."""
    cheapest = Window.partitionBy(DATE).orderBy(*[F.col(c).asc_nulls_last() for c in DEAL_ORDER])
    staged = to_staging(history).where(F.col("price_m2").isNotNull())
    lowest = staged.groupBy(DATE, F.pmod(F.xxhash64("price_m2"), F.lit(8 * top)).alias("_bucket")).agg(F.min("price_m2").alias("_low"))
    bounds = lowest.groupBy(F.col(DATE).alias("_day")).agg(F.get(F.sort_array(F.collect_list("_low")), F.lit(top - 1)).alias("_bound"))
    kept = (staged.select(*BEST_DEAL_COLUMNS).join(F.broadcast(bounds), F.col(DATE).eqNullSafe(F.col("_day")))     # one row a snapshot
            .where(F.col("_bound").isNull() | (F.col("price_m2") <= F.col("_bound"))).drop("_day", "_bound"))
    return kept.withColumn("_place", F.row_number().over(cheapest)).where(F.col("_place") <= top).drop("_place")


def listing_states(history: DataFrame) -> DataFrame:
    """Parts of the amounts per (snapshot, listing)."""
    return to_staging(history).groupBy(DATE, ID).agg(*_amounts())


STATES = {"market": market_states, "price": price_states, "deals": deal_states, "listing": listing_states}


# ------------------------------------------------------------ roll-ups ----

def _staged_cells(states: DataFrame) -> DataFrame:
    return states.where(F.col("n") > 0)


def price_evolution(states: DataFrame) -> DataFrame:
    """A1 + O1 from market states."""
    merged = _staged_cells(states).groupBy(DATE).agg(F.sum("n").alias("n"), *_merged_amounts())
    return (merged.select(DATE, _mean("price_m2").alias("avg_price_m2"), _mean("price_eur").alias("avg_price"), F.col("n").alias("nb_annonces"))
            .orderBy(F.col(DATE).asc_nulls_last()))


def typology(states: DataFrame) -> DataFrame:
    """A2 + O1 from market states."""
    merged = _staged_cells(states).groupBy(ROOMS).agg(F.sum("n").alias("n"), *_merged_amounts())
    return (merged.select(ROOMS, F.col("n").alias("nb_annonces"), _mean("price_m2").alias("avg_price_m2"),
                          _mean("price_eur").alias("avg_rent"), _mean("surface_m2").alias("avg_surface"))
            .orderBy(F.col(ROOMS).asc_nulls_last()))


def typology_labelled(states: DataFrame, seed: DataFrame) -> DataFrame:
    """J2 from market states."""
    return with_labels(typology(states), seed)


def mean_of_snapshot_means(states: DataFrame) -> DataFrame:
    """A3 + O1 from market states; a snapshot's mean has sixteen decimals."""
    daily = _staged_cells(states).groupBy(CITY, DATE).agg(*_merged_amounts())

    def inner(a: str) -> Column:
        total = (F.coalesce(F.col(f"{a}_cents"), F.lit(0).cast("decimal(28,0)")) / F.lit(100).cast("decimal(3,0)")).cast("decimal(32,2)")
        rest = F.coalesce(F.col(f"{a}_rest"), F.lit(0.0)).cast("decimal(32,6)")
        return ((total + rest).cast("decimal(24,6)") / F.nullif(F.col(f"{a}_n"), F.lit(0)).cast("decimal(12,0)")).cast("decimal(38,16)")

    def outer(c: str) -> Column:
        return round2(F.sum(c) / F.count(c).cast("decimal(12,0)"))

    return (daily.select(CITY, inner("price_m2").alias("_p"), inner("surface_m2").alias("_s"))
            .groupBy(CITY).agg(outer("_p").alias("avg_price_m2"), outer("_s").alias("avg_surface_m2"), F.count(F.lit(1)).alias("nb_weeks"))
            .orderBy(F.col("avg_price_m2").desc_nulls_last(), F.col(CITY).asc_nulls_last()))


def market_kpi(states: DataFrame) -> DataFrame:
    """A4 from market states: one row (count 0 and nulls without staged rows)."""
    merged = _staged_cells(states).agg(
        F.max(DATE).alias("last_scraping"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_annonces"),
        F.min("price_m2_min").alias("lo"), F.max("price_m2_max").alias("hi"), *_merged_amounts())
    return merged.select("last_scraping", "total_annonces", _mean("price_m2").alias("avg_price_m2"),
                         round2("lo").alias("min_price_m2"), round2("hi").alias("max_price_m2"),
                         _mean("surface_m2").alias("avg_surface"), _mean("price_eur").alias("avg_rent"))


def best_deals(prices: DataFrame, deals: DataFrame, p: float = 0.2, limit: int = TOP_ROWS) -> DataFrame:
    """J1 + O2 from price and deal states: the exact percentile of the merged
    counts, and the cheapest of the snapshots' cheapest rows. ``limit`` is at
    most the number of rows kept per snapshot."""
    cut = find_weighted_percentile(prices.groupBy("price_m2").agg(F.sum("n").alias("n")), "price_m2", "n", p)
    kept = deals.where(F.col("price_m2") <= F.lit(cut).cast("double")).select(*BEST_DEAL_COLUMNS)
    return kept.orderBy(*[F.col(c).asc_nulls_last() for c in DEAL_ORDER]).limit(limit)


def persistence(listings: DataFrame, snapshots: Sequence, limit: int | None = None) -> DataFrame:
    """A6 (+ O3) from listing states: one exchange, by listing. The rows travel
    before they are merged: a listing has one a snapshot at most, and a task's
    share of the states holds most listings, so merging there takes the memory
    of all of them and leaves nearly as many rows."""
    words = snapshot_words(snapshots)
    merged = with_ordinals(listings.repartition(ID), snapshots).groupBy(ID).agg(
        F.min(DATE).alias("first_seen"), F.max(DATE).alias("last_seen"), *seen_bits(F.col("_ordinal"), words), *_merged_amounts())
    out = merged.select(ID, "first_seen", "last_seen", seen_count(words).alias("nb_weeks_visible"), _mean("price_m2").alias("avg_price_m2"),
                        _mean("price_eur").alias("avg_rent"), _mean("surface_m2").alias("avg_surface"))
    out = out.orderBy(F.col("nb_weeks_visible").desc(), F.col(ID).asc_nulls_last())
    return out.limit(limit) if limit is not None else out


def check_report(states: DataFrame, staging_table: str, source_table: str) -> DataFrame:
    """Q4 from market states: one row per check, as ``run_checks`` gives it."""
    def entries(table: str, checks: Sequence[Check], prefix: str) -> list[Column]:
        return [F.struct(F.lit(table).alias("table"), F.lit(c.column).alias("column"), F.lit(c.name).alias("check"),
                         F.coalesce(F.col(f"{prefix}_{i}"), F.lit(0)).alias("failures")) for i, c in enumerate(checks)]

    names = [f"staging_{i}" for i in range(len(STAGING_CHECKS))] + [f"source_{i}" for i in range(len(SOURCE_CHECKS))]
    rows = entries(staging_table, STAGING_CHECKS, "staging") + entries(source_table, SOURCE_CHECKS, "source")
    return (states.agg(*[F.sum(n).alias(n) for n in names]).select(F.inline(F.array(*rows)))
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))
