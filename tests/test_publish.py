"""Versions and manifests: readers see whole runs only; the bucketed binding."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from immolens.operators import marts
from immolens.operators.gold import dedupe_first
from immolens.operators.staging import to_staging
from immolens.plans import publish as P
from immolens.plans.adapters import history_from_tables
from immolens.plans.publish import Manifest, PublishedMeanwhileError, Store, publish_refresh
from immolens.plans.refresh import CheckError, FreshnessError, NoListingsError
from immolens.schema import GOLD_COLUMNS, RAW_PAGE
from immolens.sources.files import bind_history_by_listing

AS_OF = dt.datetime(2025, 2, 9, 12)


def pages(spark, prices):
    """One page a date with one listing a price."""
    rows = []
    for day, listed in prices.items():
        html = "".join(f'<article><a href="/immobilier/{i}/" title="Appartement 2 pièces">x</a><span>40 m²</span><p>"d", e</p><div>{p} €</div></article>'
                       for i, p in enumerate(listed))
        rows.append((dt.date(2025, 2, day), 1, html, None, None, None, None, f"page-{day}"))
    return spark.createDataFrame(rows, RAW_PAGE)


def prices_of(store):
    return sorted((r.date_scraping.day, r.price_eur) for r in store.read("history").collect())


def test_runs_replace_their_dates_and_switch_at_once(spark, tmp_dir):
    store = Store(spark, tmp_dir)
    assert store.read("history").count() == 0 and store.manifest().number == 0
    with pytest.raises(FileNotFoundError):
        store.read_mart("kpi_marche")
    publish_refresh(spark, tmp_dir, pages(spark, {1: [500, 600], 8: [700]}), "https://x", AS_OF)
    held = store.read("history")                                      # a reader that started before the next run
    res = publish_refresh(spark, tmp_dir, pages(spark, {8: [710, 720, 730]}), "https://x", AS_OF)
    assert res.updated == [dt.date(2025, 2, 8)]
    assert sorted(r.price_eur for r in held.collect()) == [500, 600, 700]
    assert prices_of(store) == [(1, 500), (1, 600), (8, 710), (8, 720), (8, 730)]
    assert store.read_mart("kpi_marche").first()["total_annonces"] == 5
    assert store.read("silver").where(F.col("snapshot_date") == "2025-02-08").count() == 3
    assert store.read("gold", dates=[dt.date(2025, 2, 1)]).count() == 2


@pytest.mark.parametrize("layer", ["write_silver", "write_gold", "write_history", "marts_of", "publish"])
def test_a_run_that_dies_leaves_the_old_version(spark, tmp_dir, monkeypatch, layer):
    store = Store(spark, tmp_dir)
    publish_refresh(spark, tmp_dir, pages(spark, {1: [500]}), "https://x", dt.datetime(2025, 2, 2))
    with monkeypatch.context() as m:
        real = getattr(P, layer, None)

        def killed(*a, **k):
            if real:
                real(*a, **k)                                          # its files are there, then the job is gone
            raise KeyboardInterrupt

        m.setattr(*((Store, "publish", killed) if layer == "publish" else (P, layer, killed)))
        with pytest.raises(KeyboardInterrupt):
            publish_refresh(spark, tmp_dir, pages(spark, {1: [900], 8: [800]}), "https://x", AS_OF)
    assert prices_of(store) == [(1, 500)] and store.read_mart("kpi_marche").first()["total_annonces"] == 1
    assert len(store.remove_unpublished()) >= 1 and prices_of(store) == [(1, 500)]
    publish_refresh(spark, tmp_dir, pages(spark, {1: [900], 8: [800]}), "https://x", AS_OF)
    assert prices_of(store) == [(1, 900), (8, 800)]


def test_stopped_runs_and_runs_without_listings_publish_nothing(spark, tmp_dir):
    with pytest.raises(FreshnessError):
        publish_refresh(spark, tmp_dir, pages(spark, {1: [500]}), "https://x", dt.datetime(2025, 3, 1))
    with pytest.raises(CheckError):
        publish_refresh(spark, tmp_dir, pages(spark, {1: [500], 2: [0]}).withColumn("html", F.replace("html", F.lit("40 m²"), F.lit("4 m²"))),
                        "https://x", dt.datetime(2025, 2, 2))
    with pytest.raises(NoListingsError):
        publish_refresh(spark, tmp_dir, pages(spark, {}), "https://x", AS_OF)
    assert Store(spark, tmp_dir).manifest().number == 0


def test_two_runs_cannot_publish_the_same_number(spark, tmp_dir):
    store = Store(spark, tmp_dir)
    store.publish(Manifest(1, marts="a"))
    with pytest.raises(PublishedMeanwhileError):
        store.publish(Manifest(1, marts="b"))
    assert store.manifest().marts == "a" and [n for n in os.listdir(f"{tmp_dir}/manifest") if n.startswith("_draft")] == []


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in plan.splitlines() if "Exchange " in x and "Broadcast" not in x]


def test_work_per_listing_over_the_bucketed_table_needs_no_exchange(spark, tmp_dir):
    history = history_from_tables(spark, "/root/testdata/sf0.001")
    table = bind_history_by_listing(spark, history, f"{tmp_dir}/t", "history_bucketed", buckets=5)
    dates = sorted(r[0] for r in history.select("date_scraping").distinct().collect())
    stg = to_staging(table)
    listings = marts.listing_persistence(stg, snapshots=dates)
    assert exchanges(listings) == []
    assert exchanges(dedupe_first(table, ["date_scraping", "id_annonce"], ["price_eur", "title"], GOLD_COLUMNS)) == []
    assert sorted(map(str, listings.collect())) == sorted(map(str, marts.listing_persistence(to_staging(history)).collect()))
    again = bind_history_by_listing(spark, history.limit(10), f"{tmp_dir}/t2", "history_bucketed", buckets=2)
    assert again.count() == 10
