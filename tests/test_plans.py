"""Physical-plan checks: pushdown, pruning, join strategies, reuse."""

import datetime as dt

from pyspark.sql import functions as F

from immolens.operators import marts
from immolens.operators.cutoff import cut_at_first
from immolens.operators.staging import to_staging
from immolens.plans.adapters import history_from_tables
from immolens.plans.catalog import QUERIES
from immolens.sources.files import read_history, write_history
from immolens.sources.seed import typology_seed

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_staging_filter_and_pruning_reach_the_scan(spark, tmp_dir):
    write_history(history_from_tables(spark, SF), tmp_dir)
    stg = to_staging(read_history(spark, tmp_dir)).select("city", "price_m2")
    plan = final_plan(stg)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    pushed = scan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(price_eur)", "IsNotNull(surface_m2)", "GreaterThan(surface_m2,0)"):
        assert f in pushed
    assert "url" not in scan and "description" not in scan and "title" not in scan


def test_partition_pruning_on_snapshot_date(spark, tmp_dir):
    write_history(history_from_tables(spark, SF), tmp_dir)
    one = read_history(spark, tmp_dir).where(F.col("date_scraping") == dt.date(1995, 1, 2))
    plan = final_plan(one)
    assert "PartitionFilters: [isnotnull(date_scraping" in plan


def test_adapter_broadcasts_small_dimensions_without_shuffling_lineitem(spark):
    plan = final_plan(QUERIES["staging"](spark, SF))
    assert plan.count("BroadcastHashJoin") == 3
    assert not [l for l in plan.splitlines() if "Exchange" in l and "Broadcast" not in l]


def test_best_deals_plan(spark):
    plan = final_plan(QUERIES["best_deals_20"](spark, SF))
    assert "TakeOrderedAndProject(limit=20" in plan
    assert "BroadcastNestedLoopJoin" in plan
    assert "SPARK_PARTITION_ID" not in plan and "rangepartitioning" not in plan
    assert "percentile" not in plan.lower().replace("percentile_", "")


def test_label_join_broadcasts_the_seed(spark):
    stg = to_staging(history_from_tables(spark, SF))
    plan = final_plan(marts.typology_labelled(stg, typology_seed(spark)))
    assert "BroadcastHashJoin" in plan


def test_aggregations_are_partial_before_the_shuffle(spark):
    stg = to_staging(history_from_tables(spark, SF))
    for df in (marts.mean_of_snapshot_means(stg), marts.persistence(stg), marts.price_evolution(stg)):
        plan = final_plan(df)
        assert "partial_sum" in plan


def test_cutoff_uses_aggregate_not_window(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = final_plan(cut_at_first(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error"))
    assert "Window" not in plan


def test_extraction_is_a_map_without_shuffle(spark):
    from immolens.operators.extract import page_links
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plan = final_plan(page_links(pages, keep=["page_id"], href_prefix="/", require_title=False))
    assert "MapInArrow" in plan
    assert "Exchange" not in plan


def test_pages_are_scanned_once(spark, tmp_dir):
    """Parsing and cut-off read the page content in one pass."""
    from immolens.plans.refresh import pages_to_silver
    spark.read.parquet(f"{SF}/pages.parquet").selectExpr(
        "date'2025-01-01' AS snapshot_date", "page_id AS page_no", "html", "cast(null AS int) AS status_code", "url AS source_file",
    ).write.parquet(f"{tmp_dir}/pages")
    silver, errors = pages_to_silver(spark.read.parquet(f"{tmp_dir}/pages"), "https://x")
    for df in (silver, errors):
        plan = final_plan(df)
        assert "html" not in plan and f"{tmp_dir}/pages" not in plan


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest
    from immolens import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.scratch_folder(spark, "a") != session.scratch_folder(spark, "a")


def test_pages_are_cut_without_moving_their_rows(spark):
    from immolens.sources.pages import cut_pages
    pages = spark.range(0, 1000, numPartitions=4).selectExpr("date'2025-01-01' + cast(id % 7 AS int) AS snapshot_date", "id AS page_no",
                                                             "cast(null AS int) AS status_code", "id > 900 AS ends")
    cut = cut_pages(pages, F.col("ends"))
    plan = cut._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r[0] for r in cut.select("page_no").collect()) == list(range(908))


def test_page_table_is_written_small(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from immolens.sources.pages import read_page_table, write_page_table
    pages = spark.range(20).selectExpr("id AS page_no", "concat('<p>', id) AS html", "'f' AS source_file", "date'2025-01-01' AS snapshot_date")
    write_page_table(pages, tmp_dir)
    files = glob.glob(f"{tmp_dir}/*/*.parquet")
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(1).compression == "ZSTD" for f in files)
    assert sorted(r["html"] for r in read_page_table(spark, tmp_dir).collect()) == sorted(f"<p>{i}" for i in range(20))


def test_page_articles_are_grouped_as_fields(spark):
    from immolens.plans.adapters import listing_pages_from_tables
    plan = listing_pages_from_tables(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    grouped = [i for i, line in enumerate(lines) if "collect_list" in line]
    assert grouped and all("<article>" not in lines[i + 1] for i in grouped)      # what is shuffled to the pages


def test_listing_id_without_a_second_pattern(spark):
    from immolens.functions import listing_id
    urls = ["https://x/a/b/123/", "https://x/?q=1", "a//", "/", "", "a/\n", "a//\n", "a/b\n", "ab", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    old = F.regexp_extract(F.regexp_replace("u", r"/$", ""), r"([^/]+)$", 1)
    assert all(a == b for a, b in df.select(listing_id("u"), old).collect())
