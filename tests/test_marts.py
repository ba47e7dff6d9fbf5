"""Aggregates, joins and top-k."""

import datetime as dt
import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from immolens.operators import marts
from immolens.operators.percentile import percentile_exact
from immolens.sources.seed import typology_seed

D1, D2 = dt.date(2025, 2, 1), dt.date(2025, 2, 8)
STG = ("id_annonce string, title string, price_eur double, surface_m2 double, nb_pieces int, "
       "price_m2 double, city string, description string, date_scraping date")


def stg(spark, rows):
    full = [(i, "t", float(p), float(s), n, round(p / s, 2), c, "d", d) for i, p, s, n, c, d in rows]
    return spark.createDataFrame(full, STG)


def test_mean_of_snapshot_means_differs_from_plain_mean(spark):
    # one city, snapshot 1 has three rows at 10/m², snapshot 2 one row at 20/m²
    df = stg(spark, [("a", 100, 10, 1, "Rouen", D1), ("b", 200, 20, 1, "Rouen", D1),
                     ("c", 300, 30, 1, "Rouen", D1), ("d", 400, 20, 1, "Rouen", D2)])
    r = marts.mean_of_snapshot_means(df).collect()[0]
    assert (r["city"], r["avg_price_m2"], r["avg_surface_m2"], r["nb_weeks"]) == ("Rouen", 15.0, 20.0, 2)
    plain = marts.market_kpi(df).collect()[0]["avg_price_m2"]
    assert plain == 12.5


def test_price_evolution_and_kpi(spark):
    df = stg(spark, [("a", 100, 10, 1, "R", D1), ("b", 300, 10, 2, "R", D1), ("a", 110, 10, 1, "R", D2)])
    ev = [tuple(r) for r in marts.price_evolution(df).collect()]
    assert ev == [(D1, 20.0, 200.0, 2), (D2, 11.0, 110.0, 1)]
    k = marts.market_kpi(df).collect()[0]
    assert (k["last_scraping"], k["total_annonces"], k["min_price_m2"], k["max_price_m2"]) == (D2, 3, 10.0, 30.0)
    assert sum(r["nb_annonces"] for r in marts.price_evolution(df).collect()) == k["total_annonces"]


def test_kpi_on_empty_input(spark):
    k = marts.market_kpi(spark.createDataFrame([], STG)).collect()
    assert len(k) == 1 and k[0]["total_annonces"] == 0 and k[0]["avg_price_m2"] is None


def test_typology_null_group_last_and_labels(spark):
    df = stg(spark, [("a", 100, 10, None, "R", D1), ("b", 100, 10, 1, "R", D1), ("c", 100, 10, 7, "R", D1),
                     ("d", 100, 10, 0, "R", D1), ("e", 100, 10, 5, "R", D1)])
    t = [r["nb_pieces"] for r in marts.typology(df).collect()]
    assert t == [0, 1, 5, 7, None]
    lab = {r["nb_pieces"]: r["label_typologie"] for r in marts.typology_labelled(df, typology_seed(spark)).collect()}
    assert lab == {0: None, 1: "Studio", 5: "T5 et plus", 7: "T5 et plus", None: None}


def test_best_deals_keeps_equal_to_cut_and_breaks_ties(spark):
    rows = [(f"id{i:02d}", 100, 10, 1, "R", D1) for i in range(25)]          # 25 rows at 10/m²
    rows += [(f"x{i:02d}", 500, 10, 1, "R", D1) for i in range(75)]          # 75 rows at 50/m²
    df = stg(spark, rows)
    assert marts.price_cut(df).collect()[0][0] == 10.0
    top = [r["id_annonce"] for r in marts.best_deals(df).collect()]
    assert top == [f"id{i:02d}" for i in range(20)]
    assert marts.best_deals(df, limit=None).count() == 25


def test_persistence_counts_distinct_snapshots(spark):
    df = stg(spark, [("a", 100, 10, 1, "R", D1), ("a", 100, 10, 1, "R", D1), ("a", 120, 10, 1, "R", D2),
                     ("b", 100, 10, 1, "R", D1)])
    p = {r["id_annonce"]: r for r in marts.persistence(df).collect()}
    assert (p["a"]["first_seen"], p["a"]["last_seen"], p["a"]["nb_weeks_visible"]) == (D1, D2, 2)
    assert p["a"]["avg_rent"] == 106.67
    assert [r["id_annonce"] for r in marts.persistence(df, limit=1).collect()] == ["a"]


def brute_percentile_disc(values, p):
    vals = sorted(v for v in values if v is not None)
    if not vals:
        return None
    return vals[max(1, math.ceil(len(vals) * p)) - 1]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=60),
       st.sampled_from([0.0, 0.2, 0.5, 0.77, 1.0]))
def test_exact_percentile_matches_brute_force(spark, values, p):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = percentile_exact(df, "x", p).collect()[0][0]
    want = brute_percentile_disc(values, p)
    assert got == (None if want is None else float(want))


def test_exact_percentile_with_a_hot_value(spark):
    rng = random.Random(7)
    values = [42.0] * 3000 + [rng.uniform(0, 100) for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.2, 0.5, 0.9):
        assert percentile_exact(df, "x", p).collect()[0][0] == brute_percentile_disc(values, p)


def test_results_do_not_depend_on_shuffle_partitions(spark):
    rows = [(f"i{i % 37}", 100 + i % 11, 10 + i % 7, i % 6, f"c{i % 5}", D1 if i % 2 else D2)
            for i in range(500)]
    df = stg(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out[n] = ([tuple(r) for r in marts.best_deals(df).collect()],
                  [tuple(r) for r in marts.persistence(df, limit=20).collect()],
                  sorted(tuple(r) for r in marts.mean_of_snapshot_means(df).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out["1"] == out["8"]
