"""States on disk: incremental updates, one scan, observed metrics, footers,
ranges of dates."""

import dataclasses
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import Observation, functions as F

from immolens.operators import lattice, marts
from immolens.operators.quality import (
    SOURCE_CHECKS, STAGING_CHECKS, freshness, null_counts, run_checks, snapshot_loaded_at, written_metrics, written_report,
)
from immolens.operators.staging import to_staging
from immolens.plans import refresh as R
from immolens.plans.adapters import history_from_tables
from immolens.plans.states import update_states
from immolens.schema import GOLD, GOLD_COLUMNS
from immolens.sources.files import read_history, write_history
from immolens.sources.footers import freshness_of_files, snapshot_counts, snapshot_sizes

SF = "/root/testdata/sf0.001"
DAY = dt.date(2025, 1, 1)


def layout(root, **more):
    return R.Layout(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold", history=f"{root}/history", marts=f"{root}/marts", **more)


def hundred_dates(spark, price=100):
    """Listings i0..i29, some of them on each of 100 dates."""
    return spark.range(100 * 30).where("id % 7 < 5").selectExpr(
        "concat('i', id % 30) AS id_annonce", "'t' AS title", f"cast({price} + id % 97 AS int) AS price_eur", "cast(20 + id % 11 AS int) AS surface_m2",
        "cast(id % 5 AS int) AS nb_pieces", "cast(null AS double) AS price_m2", "concat('c', id % 4) AS city", "'d' AS description", "'u' AS url",
        "date_add(date'2025-01-01', cast(id div 30 AS int)) AS date_scraping")


def tables(spark, result):
    return {name: [tuple(r) for r in spark.read.parquet(path).collect()] for name, path in result.marts.items()}


def spoil(history, but):
    """Damages the files of all snapshots but one; their names stay."""
    for path in glob.glob(f"{history}/date_scraping=*/*.parquet"):
        if f"date_scraping={but}/" not in path:
            with open(path, "r+b") as fh:
                fh.write(b"damaged")
                fh.truncate(7)


def test_a_rerun_reads_its_own_snapshot_only(spark, tmp_dir):
    lay, day = layout(tmp_dir), DAY + dt.timedelta(days=41)
    write_history(hundred_dates(spark), lay.history)
    first = update_states(spark, lay.history, lay.states_root)
    assert len(first.updated) == len(first.snapshots) == 100
    write_history(hundred_dates(spark, 900).where(F.col("date_scraping") == F.lit(day)), lay.history)
    whole = R.build_marts(spark, dataclasses.replace(lay, states=f"{tmp_dir}/anew", marts=f"{tmp_dir}/anew_marts"), DAY, fail_on_checks=False)
    assert len(whole.updated) == 100
    spoil(lay.history, day)
    with pytest.raises(Exception):
        read_history(spark, lay.history).agg(F.sum("price_eur")).collect()
    again = update_states(spark, lay.history, lay.states_root)
    assert again.updated == [day]
    merged = {name: [tuple(r) for r in build(again, R.typology_seed(spark)).collect()] for name, build in R.MART_BUILDERS.items()}
    assert merged == tables(spark, whole)
    assert update_states(spark, lay.history, lay.states_root).updated == []


def test_an_update_that_dies_is_done_again(spark, tmp_dir, monkeypatch):
    lay = layout(tmp_dir)
    write_history(hundred_dates(spark).where("date_scraping < '2025-01-06'"), lay.history)
    with monkeypatch.context() as m:
        m.setitem(lattice.STATES, "listing", lambda h: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_states(spark, lay.history, lay.states_root)
    states = update_states(spark, lay.history, lay.states_root)
    assert len(states.updated) == 5
    stg = to_staging(read_history(spark, lay.history))
    assert lattice.market_kpi(states.market).collect() == marts.market_kpi(stg).collect()


def test_snapshots_without_staged_rows_with_null_date_and_removed_ones(spark, tmp_dir):
    rows = [("a", "t", 100, 30, 2, None, "c", "d", "u", DAY), ("b", "t", None, 30, 2, None, "c", "d", "u", DAY + dt.timedelta(days=1)),
            ("c", "t", 50, 30, 2, None, "c", "d", "u", None)]
    history, root = f"{tmp_dir}/h", f"{tmp_dir}/s"
    df = spark.createDataFrame(rows, GOLD)
    write_history(df, history)
    states = update_states(spark, history, root)
    assert len(states.updated) == 3 and states.snapshots == [DAY, DAY + dt.timedelta(days=1)]
    assert lattice.market_kpi(states.market).first()["total_annonces"] == 2
    emptied = df.where(F.col("id_annonce") == "a").withColumn("price_eur", F.lit(None).cast("int"))
    write_history(emptied, history)                                   # the snapshot's rows are no longer staged
    states = update_states(spark, history, root)
    assert states.updated == [DAY] and lattice.market_kpi(states.market).first()["total_annonces"] == 1
    assert [r.id_annonce for r in states.listing.collect()] == ["c"]
    assert update_states(spark, f"{tmp_dir}/none", root).market.count() == 0


def test_four_tables_and_all_checks_cost_one_history_scan(spark, tmp_dir):
    write_history(hundred_dates(spark), tmp_dir)
    states = lattice.market_states(read_history(spark, tmp_dir))
    states.write.parquet(f"{tmp_dir}_states")
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "description" not in plan and "title" not in plan and "url" not in plan
    stored = spark.read.parquet(f"{tmp_dir}_states")
    for df in (lattice.price_evolution(stored), lattice.typology(stored), lattice.mean_of_snapshot_means(stored),
               lattice.market_kpi(stored), lattice.check_report(stored, "s", "h")):
        df.collect()
        assert f"{tmp_dir}]" not in df._jdf.queryExecution().executedPlan().toString()


def test_the_write_observes_rows_nulls_and_checks(spark, tmp_dir):
    history = history_from_tables(spark, SF).withColumn("city", F.when(F.col("nb_pieces") != 3, F.col("city"))) \
        .withColumn("price_eur", F.when(F.col("nb_pieces") != 2, F.col("price_eur") - 2000))
    observation = Observation()
    write_history(history, tmp_dir, observation=observation, metrics=written_metrics(GOLD_COLUMNS))
    got = written_report(observation.get, GOLD_COLUMNS, "s", "h")
    back = read_history(spark, tmp_dir)
    assert got["rows"] == back.count() and got["staged_rows"] == to_staging(back).count()
    assert got["nulls"] == null_counts(back, GOLD_COLUMNS).first().asDict()
    want = run_checks(to_staging(back), "s", STAGING_CHECKS).unionByName(run_checks(back, "h", SOURCE_CHECKS))
    assert got["checks"] == [r.asDict() for r in want.collect()]


def test_counts_and_freshness_come_from_the_footers(spark, tmp_dir):
    write_history(hundred_dates(spark), tmp_dir)
    counts = snapshot_counts(spark, tmp_dir)
    got = {r[0]: r[1] for r in counts.collect()}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [date_scraping]" in plan
    back = read_history(spark, tmp_dir)
    assert got == {r[0]: r[1] for r in back.groupBy("date_scraping").count().collect()} == snapshot_sizes(spark, tmp_dir)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    for as_of in ("2025-04-11 00:00:00", "2025-04-13 12:00:00", "2025-06-01 00:00:00"):
        assert freshness_of_files(spark, tmp_dir, as_of).collect() == freshness(back, snapshot_loaded_at(), as_of).collect()
    assert freshness_of_files(spark, f"{tmp_dir}/none", "2025-01-01").first()["status"] == "error"


def listing(i, price):
    return (f'<article><a href="/immobilier/location/{i}/" title="Appartement 2 pièces">A</a><span>Rouen (76)</span>'
            f'<span>40 m2</span><p>x</p><div>{price} €</div></article>')


def write_pages(root, days):
    for d in days:
        folder = f"{root}/raw/2025-02-0{d}"
        os.makedirs(folder)
        with open(f"{folder}/page_1.html", "w", encoding="utf-8") as fh:
            fh.write(f"<html><body>{listing(d, 500 + d)}{listing(100 + d, 700)}</body></html>")


def test_backfill_of_a_range_reads_those_dates_only(spark, tmp_dir):
    from immolens.sources.pages import read_page_table, read_pages, write_page_table
    write_pages(tmp_dir, range(1, 8))
    lay = layout(tmp_dir)
    assert read_pages(spark, lay.raw, ("2025-02-03", "2025-02-05")).select("snapshot_date").distinct().count() == 3
    assert len(read_pages(spark, lay.raw, ("2025-02-03", "2025-02-05")).inputFiles()) == 3
    res = R.backfill(spark, lay, "https://x", as_of=dt.datetime(2025, 2, 6), dates=(dt.date(2025, 2, 3), "2025-02-05"))
    assert sorted(snapshot_sizes(spark, lay.history)) == [dt.date(2025, 2, d) for d in (3, 4, 5)]
    assert res.written["rows"] == 6 and res.written["nulls"]["price_eur"] == 0 and len(res.updated) == 3
    # the same from a page table, and the next range leaves the first one as it is
    write_page_table(read_pages(spark, lay.raw), f"{tmp_dir}/pages")
    assert len(read_page_table(spark, f"{tmp_dir}/pages", ("2025-02-05", "2025-02-07")).where("page_no = 1").select("snapshot_date").distinct().collect()) == 3
    more = R.backfill(spark, dataclasses.replace(lay, pages_table=f"{tmp_dir}/pages"), "https://x", as_of=dt.datetime(2025, 2, 8),
                      dates=("2025-02-06", "2025-02-07"))
    assert sorted(more.updated) == [dt.date(2025, 2, 6), dt.date(2025, 2, 7)]
    assert spark.read.parquet(more.marts["kpi_marche"]).first()["total_annonces"] == 10
    with pytest.raises(R.NoListingsError):
        R.backfill(spark, lay, "https://x", dates=("2025-03-01", "2025-03-05"))


def test_stopped_runs_carry_their_report(spark, tmp_dir):
    write_pages(tmp_dir, [1])
    with pytest.raises(R.FreshnessError) as stopped:
        R.refresh(spark, layout(tmp_dir), "2025-02-01", "https://x", as_of=dt.datetime(2025, 3, 1))
    assert stopped.value.result.freshness["status"] == "error" and stopped.value.result.written["rows"] == 2
    late = R.refresh(spark, layout(tmp_dir), "2025-02-01", "https://x", as_of=dt.datetime(2025, 2, 4, 1))
    assert late.freshness["status"] == "warn"


def test_parsed_pages_are_removed(spark, tmp_dir):
    from immolens.session import ensure_checkpoint_dir
    write_pages(tmp_dir, [1])
    R.ingest(spark, layout(tmp_dir), "2025-02-01", "https://x")
    before = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))
    R.ingest(spark, layout(tmp_dir), "2025-02-01", "https://x")
    assert set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))) == before


def test_silver_files_have_a_bounded_number_of_rows(spark, tmp_dir):
    from immolens.schema import SILVER
    from immolens.sources.files import read_silver, write_silver
    df = spark.range(1000).selectExpr("concat('t', id) AS title", "'a\nb' AS details", "'1 €' AS price", "'d' AS description", "'u' AS url",
                                      "'f' AS source_file", "id AS position", "date'2025-01-01' AS snapshot_date")
    write_silver(df.select(*SILVER.fieldNames(), "snapshot_date"), tmp_dir, rows_per_file=300)
    assert len(glob.glob(f"{tmp_dir}/*/*.csv")) >= 4 and read_silver(spark, tmp_dir).count() == 1000


def test_compressed_silver_reads_as_written(spark, tmp_dir):
    from immolens.schema import SILVER
    from immolens.sources.files import read_silver, write_silver
    df = spark.range(1000).selectExpr("concat('t \"', id, '\"') AS title", "'a\nb' AS details", "'1 €' AS price", "'d' AS description", "'u' AS url",
                                      "'f' AS source_file", "id AS position", "date'2025-01-01' AS snapshot_date").select(*SILVER.fieldNames(), "snapshot_date")
    write_silver(df, f"{tmp_dir}/plain")
    write_silver(df, f"{tmp_dir}/small", compression="gzip")
    size = {kind: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/{kind}/*/*.csv*")) for kind in ("plain", "small")}
    assert size["small"] < size["plain"] / 3 and glob.glob(f"{tmp_dir}/small/*/*.csv.gz")
    assert sorted(read_silver(spark, f"{tmp_dir}/small").collect()) == sorted(read_silver(spark, f"{tmp_dir}/plain").collect())
