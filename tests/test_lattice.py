"""Market tables rolled up from mergeable states equal the direct ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from immolens.operators import lattice, marts
from immolens.operators.percentile import find_weighted_percentile
from immolens.operators import percentile as P
from immolens.operators.quality import SOURCE_CHECKS, STAGING_CHECKS, run_checks
from immolens.operators.staging import to_staging
from immolens.plans.adapters import history_from_tables
from immolens.schema import GOLD
from immolens.sources.seed import typology_seed

SF = "/root/testdata/sf0.001"


def awkward(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 8)
    rows = [("a", "t", 100, 30, 2, 3.3, "rouen", " d ", "u", d1), ("a", "t", 100, 30, 2, 3.3, "rouen", "d", "u", d1),
            ("a", "t", 200, 3, 2, 3.3, "Rouen", "d", "u", d2), (None, None, 5, 1, None, None, None, None, None, None),
            ("b", "t", None, 30, 1, None, "x", "d", "u", d1), ("c", "t", 10, 0, 9, None, "only unstaged", "d", "u", d1),
            ("d", "t", -7, 4, 9, None, "z", "d", "u", d2), ("e", "t", 2**31 - 1, 1, 9, None, "z", "d", "u", None)]
    return spark.createDataFrame(rows, GOLD)


HISTORIES = {"tables": lambda s: history_from_tables(s, SF), "awkward": awkward, "empty": lambda s: awkward(s).limit(0)}


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(params=HISTORIES)
def history(request, spark):
    return HISTORIES[request.param](spark)


def test_roll_ups_equal_direct_marts(spark, history):
    stg, states = to_staging(history), lattice.market_states(history)
    assert rows(lattice.price_evolution(states)) == rows(marts.price_evolution(stg))
    assert rows(lattice.typology(states)) == rows(marts.typology(stg))
    assert rows(lattice.typology_labelled(states, typology_seed(spark))) == rows(marts.typology_labelled(stg, typology_seed(spark)))
    assert rows(lattice.mean_of_snapshot_means(states)) == rows(marts.mean_of_snapshot_means(stg))
    assert rows(lattice.market_kpi(states)) == rows(marts.market_kpi(stg))
    assert lattice.market_kpi(states).dtypes == marts.market_kpi(stg).dtypes
    checks = run_checks(stg, "s", STAGING_CHECKS).unionByName(run_checks(history, "h", SOURCE_CHECKS))
    assert sorted(rows(lattice.check_report(states, "s", "h"))) == sorted(rows(checks))


def test_best_deals_and_persistence_from_states(spark, history):
    stg = to_staging(history)
    deals = lattice.best_deals(lattice.price_states(history), lattice.deal_states(history))
    assert rows(deals) == rows(marts.best_deals(stg))
    dates = sorted({r[0] for r in rows(stg.select("date_scraping"))} - {None})
    listings = lattice.listing_states(history)
    for limit in (None, 20):
        assert rows(lattice.persistence(listings, dates, limit)) == rows(marts.persistence(stg, limit))


def test_bitmap_counts_distinct_snapshots(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    data = [(f"i{k % 7}", d) for k in range(7) for d in days[k * 9:k * 9 + 60 + k] for _ in range(1 + k % 2)] + [("n", None)]
    stg = spark.createDataFrame(data, "id_annonce string, date_scraping date").selectExpr(
        "*", "1D AS price_m2", "2D AS price_eur", "3D AS surface_m2")
    want = {r[0]: r[1] for r in stg.groupBy("id_annonce").agg(F.countDistinct("date_scraping")).collect()}
    assert {r.id_annonce: r.nb_weeks_visible for r in marts.persistence(stg).collect()} == want
    assert {r.id_annonce: r.nb_weeks_visible for r in marts.persistence(stg, snapshots=days).collect()} == want


def test_persistence_has_one_exchange(spark):
    df = marts.listing_persistence(to_staging(history_from_tables(spark, SF)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len([x for x in plan.splitlines() if "Exchange " in x and "Broadcast" not in x]) == 1


def test_weighted_percentile_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "LAST_ROWS", 5)
    data = [(float(i) ** 5, 1 + i % 4) for i in range(700)] + [(1e18, 3), (None, 5), (2.0, 0)]
    df = spark.createDataFrame(data, "v double, n long")
    flat = sorted(v for v, n in data if v is not None for _ in range(n))
    for p in (0.0, 0.2, 0.6, 1.0):
        assert find_weighted_percentile(df, "v", "n", p) == flat[max(1, -(-int(round(len(flat) * p * 1e6)) // 10**6)) - 1]
    assert find_weighted_percentile(df.limit(0), "v", "n", 0.5) is None


def test_mean_of_amounts_that_are_no_cents(spark):
    from immolens.functions import mean2
    data = [(1, 1e19), (1, 1e19), (2, 0.125), (2, 0.25), (3, 1.005), (3, -1.005), (4, None), (5, 10.01), (5, 10.02), (6, -0.01), (6, -0.02),
            (7, 1234567.89), (7, 0.0000001)]
    got = dict(map(tuple, spark.createDataFrame(data, "k int, x double").groupBy("k").agg(mean2("x")).collect()))
    assert got == {1: 1e19, 2: 0.19, 3: 0.0, 4: None, 5: 10.02, 6: -0.02, 7: 617283.95}
