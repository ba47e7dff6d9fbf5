"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and runs
an operator of the library; ``ORACLE_SQL`` holds the same computation as
plain SQL over the same Parquet tables. Column names and types match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from immolens.functions import (
    CITY_PATTERN, PRICE_PATTERN, clean_text, collapse_newlines, extract_city, extract_int,
    is_http_url, listing_id, price_per_m2, tolerant_date,
)
from immolens.operators import marts
from immolens.operators.cutoff import cut_at_first
from immolens.operators.extract import page_links as parse_page_links
from immolens.operators.gold import dedupe_first, to_gold
from immolens.operators.history import history_stats as h_stats
from immolens.operators.history import rows_per_snapshot as h_rows
from immolens.operators.history import union_snapshots
from immolens.operators.quality import (
    SOURCE_CHECKS, STAGING_CHECKS, freshness as q_freshness, null_counts, profile, run_checks,
    written_metrics, written_report,
)
from immolens.operators.staging import to_staging
from immolens.plans.adapters import (
    HISTORY_SQL, PAGE_ORIGIN, STAGING_SQL, history_from_tables, listing_pages_from_tables,
    silver_from_tables, sql_mean2, sql_ratio2, table,
)
from immolens.plans.publish import Store, publish_refresh
from immolens.plans.refresh import Layout, build_marts, ingest, pages_to_silver
from immolens.schema import GOLD_COLUMNS
from immolens.session import scratch_folder
from immolens.sources.files import (
    bind_history_by_listing, read_gold, read_history, read_silver, register_history, register_view, write_gold, write_history,
    write_silver,
)
from immolens.sources.footers import snapshot_sizes
from immolens.sources.pages import cut_pages, read_page_metadata, read_page_table, write_page_table
from immolens.sources.seed import TYPOLOGY_ROWS, read_seed, typology_seed

Query = Callable[[SparkSession, str], DataFrame]

FRESHNESS_AS_OF = "2024-02-02 12:00:00"
REFRESH_AS_OF = "1995-02-02 12:00:00"      # before the newest snapshot: never stale
BACKFILL_RANGE = ("1996-02-01", "1996-06-30")
PUBLISHED_RANGE = ("1997-02-01", "1997-04-30")


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_staging(history_from_tables(spark, sf_dir))


# --------------------------------------------------------------- marts ----

def price_evolution(spark, sf_dir):
    return marts.price_evolution(_stg(spark, sf_dir))


def staging(spark, sf_dir):
    return _stg(spark, sf_dir)


def staging_view(spark, sf_dir):
    """The staging rows bound to the view name and read back by name."""
    register_view(_stg(spark, sf_dir), "stg_listings")
    return spark.table("stg_listings")


def typology(spark, sf_dir):
    return marts.typology(_stg(spark, sf_dir))


def typology_labelled(spark, sf_dir):
    return marts.typology_labelled(_stg(spark, sf_dir), typology_seed(spark))


def mean_of_snapshot_means(spark, sf_dir):
    return marts.mean_of_snapshot_means(_stg(spark, sf_dir))


def market_kpi(spark, sf_dir):
    return marts.market_kpi(_stg(spark, sf_dir))


def price_cut_p20(spark, sf_dir):
    return marts.price_cut(_stg(spark, sf_dir), 0.2)


def best_deals_20(spark, sf_dir):
    return marts.best_deals(_stg(spark, sf_dir), 0.2, limit=20)


def best_deals_all(spark, sf_dir):
    return marts.best_deals(_stg(spark, sf_dir), 0.2, limit=None)


def persistence(spark, sf_dir):
    return marts.persistence(_stg(spark, sf_dir))


def persistence_top20(spark, sf_dir):
    return marts.persistence(_stg(spark, sf_dir), limit=20)


# ------------------------------------------------------------- history ----

def history_stats(spark, sf_dir):
    return h_stats(history_from_tables(spark, sf_dir))


def rows_per_snapshot(spark, sf_dir):
    return h_rows(history_from_tables(spark, sf_dir))


def null_profile(spark, sf_dir):
    return null_counts(history_from_tables(spark, sf_dir))


def table_profile(spark, sf_dir):
    return profile(history_from_tables(spark, sf_dir))


def price_per_m2_rows(spark, sf_dir):
    h = history_from_tables(spark, sf_dir)
    return h.select("id_annonce", "date_scraping", "price_eur", "surface_m2",
                    price_per_m2("price_eur", "surface_m2").alias("price_m2"))


def dedupe_in_snapshot(spark, sf_dir):
    h = history_from_tables(spark, sf_dir, keep=["l_orderkey", "l_linenumber"])
    return dedupe_first(h, ["date_scraping", "id_annonce"], ["l_orderkey", "l_linenumber"],
                        GOLD_COLUMNS)


def gold_from_text(spark, sf_dir):
    silver = silver_from_tables(spark, sf_dir)
    return to_gold(silver, F.col("snapshot_date"))


def gold_from_html(spark, sf_dir):
    """Pages -> listing extraction -> cut-off -> Gold, end to end."""
    silver, _ = pages_to_silver(listing_pages_from_tables(spark, sf_dir), PAGE_ORIGIN)
    return to_gold(silver, F.col("snapshot_date"))


def silver_csv_roundtrip(spark, sf_dir):
    """Silver written as date-partitioned, compressed CSV (quotes, line breaks inside
    fields), read back with the fixed schema, then typed to Gold."""
    path = scratch_folder(spark, "silver")
    write_silver(silver_from_tables(spark, sf_dir), path, compression="gzip")
    return to_gold(read_silver(spark, path), F.col("snapshot_date"))


def history_files_roundtrip(spark, sf_dir):
    """Gold and History written as date-partitioned Parquet, the first
    snapshot written again (a rerun replaces its partition only), the
    history bound to a name, read back, staged and aggregated."""
    root = scratch_folder(spark, "layers")
    write_gold(history_from_tables(spark, sf_dir), f"{root}/gold")
    gold = read_gold(spark, f"{root}/gold")
    write_history(gold, f"{root}/history")
    first = gold.agg(F.min("date_scraping").alias("date_scraping"))
    write_history(gold.join(F.broadcast(first), "date_scraping", "left_semi"), f"{root}/history")
    history = register_history(spark, f"{root}/history", name="listing_history_roundtrip")
    return marts.price_evolution(to_staging(history))


def union_of_snapshots(spark, sf_dir):
    """H1: three snapshots' rows, one with text dates in the second format,
    in one history; duplicates stay."""
    h = history_from_tables(spark, sf_dir, keep=["l_linenumber"])
    parts = [h.where(F.col("l_linenumber") % 3 == k) for k in range(3)]
    parts[1] = parts[1].withColumn("date_scraping", F.date_format("date_scraping", "dd-MM-yyyy"))
    return union_snapshots(*parts, parts[2])


def staging_epoch_days(spark, sf_dir):
    """V5: a history whose date is stored as a day count."""
    h = history_from_tables(spark, sf_dir)
    return to_staging(h.withColumn("date_scraping", F.unix_date("date_scraping")))


def marts_of_written_history(spark, sf_dir):
    """The second half of the refresh job over a written history
    (fixed reference time), its tables read back."""
    root = scratch_folder(spark, "refresh")
    layout = Layout(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold", history=f"{root}/history", marts=f"{root}/marts")
    write_history(history_from_tables(spark, sf_dir), layout.history)
    result = build_marts(spark, layout, REFRESH_AS_OF, fail_on_checks=False)
    evolution = spark.read.parquet(result.marts["mart_evolution_prix"])
    persistent = spark.read.parquet(result.marts["persistence_annonces"])
    return (evolution.select(F.col("date_scraping").cast("string").alias("key"), F.col("avg_price").alias("amount"), F.col("nb_annonces").alias("n"))
            .unionByName(persistent.select(F.col("id_annonce").alias("key"), F.col("avg_rent").alias("amount"), F.col("nb_weeks_visible").alias("n"))))


def _layout(root: str, **more) -> Layout:
    return Layout(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold", history=f"{root}/history", marts=f"{root}/marts", **more)


def _long_form(spark, marts_written: dict[str, str]):
    """All seven output tables read back as (table, key, a, b, c, n)."""
    shapes = {                                      # key columns, three amounts, a count
        "mart_evolution_prix": (["date_scraping"], ["avg_price_m2", "avg_price", None], "nb_annonces"),
        "mart_typologie_logement": (["nb_pieces"], ["avg_price_m2", "avg_rent", "avg_surface"], "nb_annonces"),
        "mart_typologie_libelle": (["nb_pieces", "label_typologie"], ["avg_price_m2", "avg_rent", "avg_surface"], "nb_annonces"),
        "mart_prix_moyen": (["city"], ["avg_price_m2", "avg_surface_m2", None], "nb_weeks"),
        "mart_top_annonces": (["id_annonce", "date_scraping", "title", "city", "description"], ["price_m2", "price_eur", "surface_m2"], None),
        "kpi_marche": (["last_scraping", "min_price_m2", "max_price_m2"], ["avg_price_m2", "avg_rent", "avg_surface"], "total_annonces"),
        "persistence_annonces": (["id_annonce", "first_seen", "last_seen"], ["avg_price_m2", "avg_rent", "avg_surface"], "nb_weeks_visible"),
    }
    parts = []
    for name, (keys, amounts, count) in shapes.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("decimal(18,2)").cast("string") if k.endswith("_m2") else F.col(k).cast("string"),
                                           F.lit("-")) for k in keys])
        cells = [(F.lit(None).cast("double") if a is None else F.col(a)).alias(c) for c, a in zip("abc", amounts)]
        parts.append(spark.read.parquet(marts_written[name]).select(
            F.lit(name).alias("table"), key.alias("key"), *cells, (F.lit(1) if count is None else F.col(count)).cast("long").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def refreshed_tables(spark, sf_dir):
    """All seven tables after an incremental refresh. The marts are
    built once without the newest snapshots' last rows; then those snapshots
    are written again, whole, and only their states are made anew."""
    layout = _layout(scratch_folder(spark, "incremental"))
    history = history_from_tables(spark, sf_dir)
    write_history(history, layout.history)
    newest = read_history(spark, layout.history).agg(F.max("date_scraping")).first()[0]
    recent = F.col("date_scraping") > F.lit(newest) - F.expr("INTERVAL 60 DAYS")
    write_history(history.where(recent & (F.col("nb_pieces") > 2)), layout.history)        # a run that saw part of them
    build_marts(spark, layout, REFRESH_AS_OF, fail_on_checks=False)
    write_history(history.where(recent), layout.history)
    return _long_form(spark, build_marts(spark, layout, REFRESH_AS_OF, fail_on_checks=False).marts)


def backfill_of_a_range(spark, sf_dir):
    """Pages written as a page table, the first half of the job run
    over a range of dates, its Gold read back."""
    root = scratch_folder(spark, "backfill")
    layout = _layout(root, pages_table=f"{root}/pages")
    write_page_table(listing_pages_from_tables(spark, sf_dir), layout.pages_table)
    ingest(spark, layout, BACKFILL_RANGE, PAGE_ORIGIN)
    return read_gold(spark, layout.gold)


def observed_history(spark, sf_dir):
    """What the History write itself observed."""
    observation = Observation()
    write_history(history_from_tables(spark, sf_dir), scratch_folder(spark, "observed"),
                  observation=observation, metrics=written_metrics(GOLD_COLUMNS))
    report = written_report(observation.get, GOLD_COLUMNS, "stg_listings", "listing_history")
    rows = ([("rows", report["rows"])] + [(f"null {c}", n) for c, n in report["nulls"].items()]
            + [(f"{c['table']} {c['column']} {c['check']}", c["failures"]) for c in report["checks"]])
    return spark.createDataFrame(rows, "metric string, value long")


def snapshot_counts_from_footers(spark, sf_dir):
    """H4, Q3: rows per snapshot of a written history, from its footers."""
    path = scratch_folder(spark, "footers")
    write_history(history_from_tables(spark, sf_dir), path)
    return spark.createDataFrame(list(snapshot_sizes(spark, path).items()), "date_scraping date, count long")


def persistence_by_listing_table(spark, sf_dir):
    """Persistence over the history bound as a table bucketed and
    sorted by listing: no exchange before the final order."""
    path = scratch_folder(spark, "by-listing")
    history = bind_history_by_listing(spark, history_from_tables(spark, sf_dir), path, f"history_{path.rsplit('-', 1)[1]}")
    return marts.persistence(to_staging(history))


def published_history(spark, sf_dir):
    """Two published refreshes of generated pages (the second
    replaces some snapshots by the same pages), the Gold layer read as published."""
    root = scratch_folder(spark, "published")
    pages = listing_pages_from_tables(spark, sf_dir).where(F.col("snapshot_date").between(*[F.lit(d).cast("date") for d in PUBLISHED_RANGE]))
    publish_refresh(spark, root, pages, PAGE_ORIGIN, REFRESH_AS_OF, fail_on_checks=False)
    publish_refresh(spark, root, pages.where(F.month("snapshot_date") == 3), PAGE_ORIGIN, REFRESH_AS_OF, fail_on_checks=False)
    return Store(spark, root).read("history")


def typology_seed_csv(spark, sf_dir):
    """The reference table written as CSV and read back as the seed."""
    path = scratch_folder(spark, "seed")
    typology_seed(spark).write.option("header", True).csv(path)
    return marts.typology_labelled(_stg(spark, sf_dir), read_seed(spark, path))


def approximate_cut(spark, sf_dir):
    """A5 by sketch: is the rank of the approximate percentile within the
    promised n / accuracy (+1 for the discrete target) of the wanted one?"""
    stg = _stg(spark, sf_dir).select("price_m2")
    accuracy = 1000
    cut = marts.price_cut(stg, 0.2, method="approx", accuracy=accuracy, alias="cut")
    ranks = stg.crossJoin(F.broadcast(cut)).agg(                          # the cut is one row
        F.count("price_m2").alias("n"), F.count_if(F.col("price_m2") < F.col("cut")).alias("below"),
        F.count_if(F.col("price_m2") <= F.col("cut")).alias("upto"))
    slack = F.col("n") / accuracy + 1
    return ranks.select("n", ((F.col("below") <= F.col("n") * 0.2 + slack) & (F.col("upto") >= F.col("n") * 0.2 - slack)).alias("within"))


# ------------------------------------------------------------- quality ----

def quality_checks(spark, sf_dir):
    h = history_from_tables(spark, sf_dir)
    return (run_checks(to_staging(h), "stg_listings", STAGING_CHECKS)
            .unionByName(run_checks(h, "listing_history", SOURCE_CHECKS)))


def freshness(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return q_freshness(events, F.col("ts"), FRESHNESS_AS_OF)


# ---------------------------------------------------- text and pages ------

def tolerant_date_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
             .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd-MM-yyyy"))
             .otherwise(F.concat(F.lit("unknown-"), F.col("o_orderkey").cast("string"))))
    return o.select("o_orderkey", text.alias("date_text")).withColumn(
        "date_scraping", tolerant_date("date_text"))


def city_from_text(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 4
    details = (F.when(k == 0, F.concat(F.lit("Appartement T2 45 m² "), F.col("s_name"), F.lit(" Rouen (76)")))
                .when(k == 1, F.concat(F.lit("Maison à Mont-Saint-Aignan (76) "), F.col("s_name")))
                .when(k == 2, F.concat(F.lit("Studio "), F.col("s_name"), F.lit(" sans ville"))))
    return s.select("s_suppkey", details.alias("details")).withColumn("city", extract_city("details"))


def number_from_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        extract_int("text", r"(\d+)").alias("first_number"),
        extract_int(F.lower("text"), r"version\s*(\d+)").alias("version_number"),
        extract_int("text", PRICE_PATTERN).alias("price_eur"),
    )


def clean_whitespace(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", clean_text("text").alias("text_clean"),
                    collapse_newlines("text").alias("text_one_line"))


def page_cutoff(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return cut_at_first(events, ["user_id"], ["ts", "event_id"],
                        stop_after=F.col("event_type") == "error")


def page_cutoff_status(spark, sf_dir):
    """Both stop rules, with pages that have no number."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 11 != 0, F.col("event_id")).alias("page_no"),
        F.when(F.col("event_type") == "error", F.lit(503)).alias("status_code"),
        (F.col("event_type") == "purchase").alias("ends"))
    return cut_pages(events, F.col("ends"), date_col="user_id").drop("ends")


def pages_from_table_files(spark, sf_dir):
    """A page table written by date, with metadata as JSON lines, read
    back with its status codes."""
    root = scratch_folder(spark, "raw")
    p = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 5).cast("int"))
    (p.select(day.alias("snapshot_date"), F.col("page_id").alias("page_no"), "html", F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("source_file"))
     .write.partitionBy("snapshot_date").parquet(f"{root}/pages"))
    (p.where("page_id % 3 <> 0").select(day.alias("snapshot_date"), F.col("page_id").alias("page_no"), F.col("url").alias("source_url"),
                                         F.repeat(F.col("url"), 20).alias("user_agent"), F.when(F.col("page_id") % 7 == 0, 404).otherwise(200).alias("status_code"))
     .write.json(f"{root}/meta"))
    pages = read_page_table(spark, f"{root}/pages", metadata=read_page_metadata(spark, f"{root}/meta"))
    return pages.select("snapshot_date", "page_no", "source_url", F.length("user_agent").alias("agent_chars"), "status_code", F.md5("html").alias("html_md5"), "source_file")


def broken_pages(spark, sf_dir):
    """Markup that the parser rejects costs that page only."""
    pages = table(spark, sf_dir, "pages")
    html = F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("<![foo[x]]>"))).otherwise(F.col("html"))
    links = parse_page_links(pages.select("page_id", html.alias("html")), keep=["page_id"], href_prefix="/", require_title=False)
    return links.groupBy("page_id").agg(F.count_if(F.col("error").isNull()).alias("links"), F.count_if(F.col("error").isNotNull()).alias("errors"))


def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = parse_page_links(pages, keep=["page_id", "url"], href_prefix="/", require_title=False)
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    return links.select("page_id", "position", "href",
                        F.concat(origin, F.col("href")).alias("link_url"),
                        clean_text("details").alias("details"))


def page_slug(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.where(is_http_url("url")).select("page_id", "url", listing_id("url").alias("id_annonce"))


QUERIES: dict[str, Query] = {
    "price_evolution": price_evolution,
    "staging": staging,
    "staging_view": staging_view,
    "typology": typology,
    "typology_labelled": typology_labelled,
    "mean_of_snapshot_means": mean_of_snapshot_means,
    "market_kpi": market_kpi,
    "price_cut_p20": price_cut_p20,
    "best_deals_20": best_deals_20,
    "best_deals_all": best_deals_all,
    "persistence": persistence,
    "persistence_top20": persistence_top20,
    "history_stats": history_stats,
    "rows_per_snapshot": rows_per_snapshot,
    "null_profile": null_profile,
    "table_profile": table_profile,
    "price_per_m2": price_per_m2_rows,
    "dedupe_in_snapshot": dedupe_in_snapshot,
    "gold_from_text": gold_from_text,
    "gold_from_html": gold_from_html,
    "silver_csv_roundtrip": silver_csv_roundtrip,
    "history_files_roundtrip": history_files_roundtrip,
    "union_of_snapshots": union_of_snapshots,
    "staging_epoch_days": staging_epoch_days,
    "marts_of_written_history": marts_of_written_history,
    "persistence_by_listing_table": persistence_by_listing_table,
    "published_history": published_history,
    "refreshed_tables": refreshed_tables,
    "backfill_of_a_range": backfill_of_a_range,
    "observed_history": observed_history,
    "snapshot_counts_from_footers": snapshot_counts_from_footers,
    "typology_seed_csv": typology_seed_csv,
    "approximate_cut": approximate_cut,
    "quality_checks": quality_checks,
    "freshness": freshness,
    "tolerant_date": tolerant_date_text,
    "city_from_text": city_from_text,
    "number_from_text": number_from_text,
    "clean_whitespace": clean_whitespace,
    "page_cutoff": page_cutoff,
    "page_cutoff_status": page_cutoff_status,
    "pages_from_table_files": pages_from_table_files,
    "broken_pages": broken_pages,
    "page_links": page_links,
    "page_slug": page_slug,
}


# ---------------------------------------------------------- oracle SQL ----

# Python whitespace as a regex class (same as the Spark side).
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"


def _sql_clean_text(x: str) -> str:
    inner = (f"replace(replace(translate({x}, chr(13) || chr(10), '  '), 'm 2', 'm²'), 'm2', 'm²')")
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL "
            f"ELSE trim(regexp_replace({inner}, '{_WS}', ' ', 'g')) END")


_CITY = CITY_PATTERN
_SEED_VALUES = ", ".join(f"({n}, '{label}')" for n, label, _ in TYPOLOGY_ROWS)

_STAGING_TYPES = [("id_annonce", "string"), ("title", "string"), ("price_eur", "int"),
                  ("surface_m2", "int"), ("nb_pieces", "int"), ("price_m2", "double"),
                  ("city", "string"), ("description", "string"), ("url", "string"),
                  ("date_scraping", "date")]

_SILVER_SQL = r"""
silver AS (
  SELECT CASE WHEN l.l_linenumber % 3 = 0 THEN 'Studio ' || p.p_name
              ELSE 'Appartement ' || CAST(p.p_size % 8 AS VARCHAR) || ' Pièces ' || upper(p.p_name) END AS title,
         p.p_type || ' ' || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || ' m² - '
           || substr(n.n_name, 1, 1) || lower(translate(substr(n.n_name, 2), '0123456789_', 'abcdefghij '))
           || CASE WHEN l.l_linenumber % 4 = 0 THEN '' ELSE ' (76)' END AS details,
         CASE WHEN l.l_linenumber % 5 = 0 THEN 'Prix sur demande'
              ELSE CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) || ' €' END AS price,
         p.p_type || chr(13) || chr(10) || p.p_name || chr(10) || chr(10) || 'Bel appartement' AS description,
         CASE WHEN l.l_linenumber = 7 THEN 'ftp://listings.example/' || CAST(l.l_partkey AS VARCHAR)
              WHEN l.l_linenumber % 2 = 0 THEN 'https://listings.example/annonce/' || CAST(l.l_partkey AS VARCHAR)
              ELSE 'https://listings.example/annonce/' || CAST(l.l_partkey AS VARCHAR) || '/' END AS url,
         'raw/' || CAST(CAST(date_trunc('week', l.l_shipdate) AS DATE) AS VARCHAR) || '/page_'
           || CAST(l.l_orderkey % 10 AS VARCHAR) || '.html' AS source_file,
         l.l_orderkey * 8 + l.l_linenumber AS position,
         CAST(date_trunc('week', l.l_shipdate) AS DATE) AS snapshot_date
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

_HTML_SILVER_SQL = r"""
obs AS (
  SELECT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week, l.l_orderkey, l.l_linenumber AS ln,
         CASE WHEN l.l_linenumber % 3 = 0 THEN 'Studio ' || p.p_name
              ELSE 'Appartement ' || CAST(p.p_size % 8 AS VARCHAR) || ' Pièces ' || upper(p.p_name) END AS title,
         p.p_type || ' ' || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || ' m² - '
           || substr(n.n_name, 1, 1) || lower(translate(substr(n.n_name, 2), '0123456789_', 'abcdefghij '))
           || CASE WHEN l.l_linenumber % 4 = 0 THEN '' ELSE ' (76)' END AS details,
         CASE WHEN l.l_linenumber % 5 <> 0
              THEN CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) || ' €' END AS price,
         CASE WHEN l.l_linenumber % 6 <> 0
              THEN p.p_type || chr(13) || chr(10) || p.p_name || chr(10) || chr(10) || 'Bel appartement' END AS description,
         '/immobilier/annonce/' || CAST(l.l_partkey AS VARCHAR)
           || CASE WHEN l.l_linenumber % 2 = 0 THEN '' ELSE '/' END AS href
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
kept AS (
  SELECT o.*, CAST(floor(l_orderkey / 4096) AS BIGINT) AS page_no,
         row_number() OVER (PARTITION BY week, floor(l_orderkey / 4096) ORDER BY l_orderkey, ln) AS position
  FROM obs o
),
silver AS (
  SELECT {clean_title} AS title,
         {clean_details} AS details,
         {clean_price} AS price,
         {clean_desc} AS description,
         'https://listings.example' || href AS url,
         'raw/' || CAST(week AS VARCHAR) || '/page_' || CAST(page_no AS VARCHAR) || '.html' AS source_file,
         position,
         week AS snapshot_date
  FROM kept
  WHERE ln <> 7 AND (price IS NOT NULL OR description IS NOT NULL)
)"""


def _gold_from_silver_sql(silver_cte: str) -> str:
    return f"""WITH {silver_cte},
typed AS (
  SELECT regexp_extract(regexp_replace(url, '/$', ''), '([^/]+)$', 1) AS id_annonce,
         trim(title) AS title,
         TRY_CAST(regexp_extract(price, '(\\d+)\\s*€', 1) AS INTEGER) AS price_eur,
         TRY_CAST(regexp_extract(details, '(\\d+)\\s*m²', 1) AS INTEGER) AS surface_m2,
         TRY_CAST(regexp_extract(lower(title), '(\\d+)\\s*pièce', 1) AS INTEGER) AS nb_pieces,
         coalesce(nullif(trim(regexp_extract(details, '{_CITY}', 1)), ''), 'Rouen') AS city,
         regexp_replace(description, '[\\r\\n]+', ' ', 'g') AS description,
         url, snapshot_date AS date_scraping, source_file, position
  FROM silver WHERE regexp_matches(url, '^https?://'))
SELECT id_annonce, title, price_eur, surface_m2, nb_pieces,
       CASE WHEN price_eur IS NOT NULL AND surface_m2 > 0
            THEN {sql_ratio2('price_eur', 'surface_m2')} END AS price_m2,
       city, description, url, date_scraping
FROM typed
QUALIFY row_number() OVER (PARTITION BY date_scraping, id_annonce ORDER BY source_file, position) = 1"""


def _daily(x: str) -> str:
    """A group's mean in units of 10^-14."""
    return f"CAST(sum(CAST(round({x} * 100) AS HUGEINT)) * 1000000000000 AS HUGEINT) // count({x})"


def _over_days(x: str) -> str:
    """The mean of such means, to two decimals."""
    n = f"CAST(count({x}) * 1000000000000 AS HUGEINT)"
    return f"CAST((CAST(2 * sum({x}) AS HUGEINT) + {n}) // (2 * {n}) / 100.0 AS DOUBLE)"


ORACLE_SQL: dict[str, str] = {
    "price_evolution": f"""WITH {STAGING_SQL}
SELECT date_scraping, {sql_mean2('price_m2')} AS avg_price_m2, {sql_mean2('price_eur')} AS avg_price,
       count(*) AS nb_annonces
FROM stg GROUP BY date_scraping ORDER BY date_scraping""",

    "staging": f"""WITH {STAGING_SQL}
SELECT id_annonce, title, price_eur, surface_m2, nb_pieces, price_m2, city, description, date_scraping FROM stg""",

    "typology": f"""WITH {STAGING_SQL}
SELECT nb_pieces, count(*) AS nb_annonces, {sql_mean2('price_m2')} AS avg_price_m2,
       {sql_mean2('price_eur')} AS avg_rent, {sql_mean2('surface_m2')} AS avg_surface
FROM stg GROUP BY nb_pieces ORDER BY nb_pieces NULLS LAST""",

    "typology_labelled": f"""WITH {STAGING_SQL},
seed(seed_rooms, label_typologie) AS (VALUES {_SEED_VALUES}),
t AS (SELECT nb_pieces, count(*) AS nb_annonces, {sql_mean2('price_m2')} AS avg_price_m2,
             {sql_mean2('price_eur')} AS avg_rent, {sql_mean2('surface_m2')} AS avg_surface
      FROM stg GROUP BY nb_pieces)
SELECT t.nb_pieces, s.label_typologie, t.nb_annonces, t.avg_price_m2, t.avg_rent, t.avg_surface
FROM t LEFT JOIN seed s ON (CASE WHEN t.nb_pieces >= 5 THEN 5 ELSE t.nb_pieces END) = s.seed_rooms
ORDER BY t.nb_pieces NULLS LAST""",

    "mean_of_snapshot_means": f"""WITH {STAGING_SQL},
daily AS (SELECT city, {_daily('price_m2')} AS p, {_daily('surface_m2')} AS s FROM stg GROUP BY city, date_scraping)
SELECT city, {_over_days('p')} AS avg_price_m2, {_over_days('s')} AS avg_surface_m2, count(*) AS nb_weeks
FROM daily GROUP BY city ORDER BY avg_price_m2 DESC NULLS LAST, city""",

    "market_kpi": f"""WITH {STAGING_SQL}
SELECT max(date_scraping) AS last_scraping, count(*) AS total_annonces,
       {sql_mean2('price_m2')} AS avg_price_m2, min(price_m2) AS min_price_m2,
       max(price_m2) AS max_price_m2, {sql_mean2('surface_m2')} AS avg_surface,
       {sql_mean2('price_eur')} AS avg_rent
FROM stg""",

    "price_cut_p20": f"""WITH {STAGING_SQL}
SELECT quantile_disc(price_m2, 0.2) AS p20 FROM stg""",

    "best_deals_20": f"""WITH {STAGING_SQL}
SELECT id_annonce, title, city, price_eur, surface_m2, price_m2, date_scraping, description
FROM stg
WHERE price_m2 <= (SELECT quantile_disc(price_m2, 0.2) FROM stg)
ORDER BY price_m2, id_annonce, date_scraping, price_eur, surface_m2, title, city, description
LIMIT 20""",

    "best_deals_all": f"""WITH {STAGING_SQL}
SELECT id_annonce, title, city, price_eur, surface_m2, price_m2, date_scraping, description
FROM stg
WHERE price_m2 <= (SELECT quantile_disc(price_m2, 0.2) FROM stg)""",

    "persistence": f"""WITH {STAGING_SQL}
SELECT id_annonce, min(date_scraping) AS first_seen, max(date_scraping) AS last_seen,
       count(DISTINCT date_scraping) AS nb_weeks_visible, {sql_mean2('price_m2')} AS avg_price_m2,
       {sql_mean2('price_eur')} AS avg_rent, {sql_mean2('surface_m2')} AS avg_surface
FROM stg GROUP BY id_annonce""",

    "persistence_top20": f"""WITH {STAGING_SQL}
SELECT id_annonce, min(date_scraping) AS first_seen, max(date_scraping) AS last_seen,
       count(DISTINCT date_scraping) AS nb_weeks_visible, {sql_mean2('price_m2')} AS avg_price_m2,
       {sql_mean2('price_eur')} AS avg_rent, {sql_mean2('surface_m2')} AS avg_surface
FROM stg GROUP BY id_annonce ORDER BY nb_weeks_visible DESC, id_annonce LIMIT 20""",

    "history_stats": f"""WITH {HISTORY_SQL}
SELECT count(*) AS total_rows,
       CAST(count(DISTINCT id_annonce) + max(CASE WHEN id_annonce IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_ids,
       CAST(count(DISTINCT date_scraping) + max(CASE WHEN date_scraping IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_dates
FROM history""",

    "rows_per_snapshot": f"""WITH {HISTORY_SQL}
SELECT date_scraping, count(*) AS count FROM history GROUP BY date_scraping ORDER BY date_scraping""",

    "null_profile": f"""WITH {HISTORY_SQL}
SELECT {", ".join(f"count_if({c} IS NULL) AS {c}" for c, _ in _STAGING_TYPES)} FROM history""",

    "table_profile": f"""WITH {HISTORY_SQL}
{" UNION ALL ".join(f"SELECT '{c}' AS column, '{t}' AS type, count(*) AS rows, count_if({c} IS NULL) AS nulls FROM history"
                    for c, t in _STAGING_TYPES)}""",

    "price_per_m2": f"""WITH {HISTORY_SQL}
SELECT id_annonce, date_scraping, price_eur, surface_m2,
       CASE WHEN price_eur IS NOT NULL AND surface_m2 > 0
            THEN {sql_ratio2('price_eur', 'surface_m2')} END AS price_m2
FROM history""",

    "dedupe_in_snapshot": f"""WITH {HISTORY_SQL}
SELECT id_annonce, title, price_eur, surface_m2, nb_pieces, price_m2, city, description, url, date_scraping
FROM history
QUALIFY row_number() OVER (PARTITION BY date_scraping, id_annonce ORDER BY l_orderkey, l_linenumber) = 1""",

    "gold_from_text": f"""WITH {_SILVER_SQL},
typed AS (
  SELECT regexp_extract(regexp_replace(url, '/$', ''), '([^/]+)$', 1) AS id_annonce,
         trim(title) AS title,
         TRY_CAST(regexp_extract(price, '(\\d+)\\s*€', 1) AS INTEGER) AS price_eur,
         TRY_CAST(regexp_extract(details, '(\\d+)\\s*m²', 1) AS INTEGER) AS surface_m2,
         TRY_CAST(regexp_extract(lower(title), '(\\d+)\\s*pièce', 1) AS INTEGER) AS nb_pieces,
         coalesce(nullif(trim(regexp_extract(details, '{_CITY}', 1)), ''), 'Rouen') AS city,
         regexp_replace(description, '[\\r\\n]+', ' ', 'g') AS description,
         url, snapshot_date AS date_scraping, source_file, position
  FROM silver WHERE regexp_matches(url, '^https?://'))
SELECT id_annonce, title, price_eur, surface_m2, nb_pieces,
       CASE WHEN price_eur IS NOT NULL AND surface_m2 > 0
            THEN {sql_ratio2('price_eur', 'surface_m2')} END AS price_m2,
       city, description, url, date_scraping
FROM typed
QUALIFY row_number() OVER (PARTITION BY date_scraping, id_annonce ORDER BY source_file, position) = 1""",

    "gold_from_html": _gold_from_silver_sql(_HTML_SILVER_SQL.format(
        clean_title=_sql_clean_text("title"),
        clean_details=_sql_clean_text("concat_ws(' ', title, details, description, price)"),
        clean_price=_sql_clean_text("price"),
        clean_desc=_sql_clean_text("description"))),

    "quality_checks": f"""WITH {STAGING_SQL},
c AS (SELECT count_if(id_annonce IS NULL) AS c0, count_if(price_eur IS NULL) AS c1,
             count_if(price_eur IS NOT NULL AND NOT (price_eur >= 0)) AS c2,
             count_if(surface_m2 IS NULL) AS c3,
             count_if(surface_m2 IS NOT NULL AND NOT (surface_m2 >= 5)) AS c4,
             count_if(price_m2 IS NULL) AS c5, count_if(date_scraping IS NULL) AS c6 FROM stg),
h AS (SELECT count_if(id_annonce IS NULL) AS c0, count_if(date_scraping IS NULL) AS c1 FROM history),
r AS (
  SELECT 'stg_listings' AS "table", 'id_annonce' AS "column", 'not_null' AS "check", c0 AS failures FROM c
  UNION ALL SELECT 'stg_listings', 'price_eur', 'not_null', c1 FROM c
  UNION ALL SELECT 'stg_listings', 'price_eur', 'between[0,]', c2 FROM c
  UNION ALL SELECT 'stg_listings', 'surface_m2', 'not_null', c3 FROM c
  UNION ALL SELECT 'stg_listings', 'surface_m2', 'between[5,]', c4 FROM c
  UNION ALL SELECT 'stg_listings', 'price_m2', 'not_null', c5 FROM c
  UNION ALL SELECT 'stg_listings', 'date_scraping', 'not_null', c6 FROM c
  UNION ALL SELECT 'listing_history', 'id_annonce', 'not_null', c0 FROM h
  UNION ALL SELECT 'listing_history', 'date_scraping', 'not_null', c1 FROM h)
SELECT "table", "column", "check", failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r""",

    "freshness": f"""SELECT max(ts) AS max_loaded_at, TIMESTAMP '{FRESHNESS_AS_OF}' AS as_of,
       (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(max(ts))) / 3600000000.0 AS age_hours,
       CASE WHEN max(ts) IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(max(ts))) / 3600000000.0 > 96 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(max(ts))) / 3600000000.0 > 48 THEN 'warn'
            ELSE 'pass' END AS status
FROM events""",

    "tolerant_date": """WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
              ELSE 'unknown-' || CAST(o_orderkey AS VARCHAR) END AS date_text
  FROM orders)
SELECT o_orderkey, date_text,
       CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%d-%m-%Y')) AS DATE) AS date_scraping
FROM t""",

    "city_from_text": f"""WITH t AS (
  SELECT s_suppkey,
         CASE WHEN s_suppkey % 4 = 0 THEN 'Appartement T2 45 m² ' || s_name || ' Rouen (76)'
              WHEN s_suppkey % 4 = 1 THEN 'Maison à Mont-Saint-Aignan (76) ' || s_name
              WHEN s_suppkey % 4 = 2 THEN 'Studio ' || s_name || ' sans ville' END AS details
  FROM supplier)
SELECT s_suppkey, details, coalesce(nullif(trim(regexp_extract(details, '{_CITY}', 1)), ''), 'Rouen') AS city
FROM t""",

    "number_from_text": r"""SELECT doc_id,
       TRY_CAST(regexp_extract(text, '(\d+)', 1) AS INTEGER) AS first_number,
       TRY_CAST(regexp_extract(lower(text), 'version\s*(\d+)', 1) AS INTEGER) AS version_number,
       TRY_CAST(regexp_extract(text, '(\d+)\s*€', 1) AS INTEGER) AS price_eur
FROM documents""",

    "clean_whitespace": f"""SELECT conv_id, turn, {_sql_clean_text('text')} AS text_clean,
       regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text_one_line
FROM conversations""",

    "page_cutoff": """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM events) WHERE seen = 0""",

    "page_links": f"""WITH l AS (
  SELECT page_id, url,
         unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS href,
         unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2)) AS txt,
         generate_subscripts(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1), 1) AS position
  FROM pages)
SELECT page_id, CAST(position AS INTEGER) AS position, href,
       regexp_extract(url, '^(https?://[^/?#]+)', 1) || href AS link_url,
       {_sql_clean_text('txt')} AS details
FROM l""",

    "page_slug": """SELECT page_id, url, regexp_extract(regexp_replace(url, '/$', ''), '([^/]+)$', 1) AS id_annonce
FROM pages WHERE regexp_matches(url, '^https?://')""",
}

ORACLE_SQL["silver_csv_roundtrip"] = ORACLE_SQL["gold_from_text"]
ORACLE_SQL["history_files_roundtrip"] = ORACLE_SQL["price_evolution"]
ORACLE_SQL["staging_view"] = ORACLE_SQL["staging"]
ORACLE_SQL["staging_epoch_days"] = ORACLE_SQL["staging"]
ORACLE_SQL["typology_seed_csv"] = ORACLE_SQL["typology_labelled"]

ORACLE_SQL["union_of_snapshots"] = f"""WITH {HISTORY_SQL}
SELECT id_annonce, title, price_eur, surface_m2, nb_pieces, price_m2, city, description, url, date_scraping
FROM history, (VALUES (0, 1), (1, 1), (2, 1), (2, 2)) AS copies(part, copy)
WHERE l_linenumber % 3 = copies.part"""

ORACLE_SQL["marts_of_written_history"] = f"""WITH {STAGING_SQL}
SELECT CAST(date_scraping AS VARCHAR) AS key, {sql_mean2('price_eur')} AS amount, count(*) AS n FROM stg GROUP BY date_scraping
UNION ALL
SELECT * FROM (SELECT id_annonce, {sql_mean2('price_eur')}, count(DISTINCT date_scraping) AS n
               FROM stg GROUP BY id_annonce ORDER BY n DESC, id_annonce LIMIT 20)"""

ORACLE_SQL["approximate_cut"] = f"""WITH {STAGING_SQL}
SELECT count(price_m2) AS n, true AS within FROM stg"""

ORACLE_SQL["page_cutoff_status"] = """WITH e AS (
  SELECT user_id, event_id, CASE WHEN event_id % 11 <> 0 THEN event_id END AS page_no,
         CASE WHEN event_type = 'error' THEN 503 END AS status_code, event_type FROM events),
s AS (
  SELECT user_id, min(page_no) FILTER (event_type = 'purchase') AS last, min(page_no) FILTER (event_type = 'error') AS failed
  FROM e GROUP BY user_id)
SELECT e.user_id, event_id, page_no, CAST(status_code AS INTEGER) AS status_code FROM e JOIN s USING (user_id)
WHERE CASE WHEN page_no IS NULL THEN status_code IS NULL
           ELSE page_no <= coalesce(last, page_no) AND (failed IS NULL OR page_no < failed) END"""

ORACLE_SQL["pages_from_table_files"] = """SELECT CAST(DATE '2025-01-01' + CAST(page_id % 5 AS INTEGER) AS DATE) AS snapshot_date, page_id AS page_no,
       CASE WHEN page_id % 3 <> 0 THEN url END AS source_url,
       CASE WHEN page_id % 3 <> 0 THEN CAST(least(250, 20 * length(url)) AS INTEGER) END AS agent_chars,
       CAST(CASE WHEN page_id % 3 <> 0 THEN CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END END AS INTEGER) AS status_code,
       md5(html) AS html_md5, 'page_' || CAST(page_id AS VARCHAR) || '.html' AS source_file
FROM pages"""

ORACLE_SQL["broken_pages"] = """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 0 ELSE n END AS links, CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS errors
FROM (SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS BIGINT) AS n FROM pages)
WHERE n > 0 OR page_id % 5 = 0"""

ORACLE_SQL["snapshot_counts_from_footers"] = ORACLE_SQL["rows_per_snapshot"]

ORACLE_SQL["backfill_of_a_range"] = f"""SELECT * FROM ({ORACLE_SQL["gold_from_html"]})
WHERE date_scraping BETWEEN DATE '{BACKFILL_RANGE[0]}' AND DATE '{BACKFILL_RANGE[1]}'"""

ORACLE_SQL["observed_history"] = f"""WITH {STAGING_SQL}, h AS (SELECT 'rows' AS metric, count(*) AS value FROM history
  {" ".join(f"UNION ALL SELECT 'null {c}', count_if({c} IS NULL) FROM history" for c, _ in _STAGING_TYPES)}
  UNION ALL SELECT 'stg_listings id_annonce not_null', count_if(id_annonce IS NULL) FROM stg
  UNION ALL SELECT 'stg_listings price_eur not_null', count_if(price_eur IS NULL) FROM stg
  UNION ALL SELECT 'stg_listings price_eur between[0,]', count_if(price_eur < 0) FROM stg
  UNION ALL SELECT 'stg_listings surface_m2 not_null', count_if(surface_m2 IS NULL) FROM stg
  UNION ALL SELECT 'stg_listings surface_m2 between[5,]', count_if(surface_m2 < 5) FROM stg
  UNION ALL SELECT 'stg_listings price_m2 not_null', count_if(price_m2 IS NULL) FROM stg
  UNION ALL SELECT 'stg_listings date_scraping not_null', count_if(date_scraping IS NULL) FROM stg
  UNION ALL SELECT 'listing_history id_annonce not_null', count_if(id_annonce IS NULL) FROM history
  UNION ALL SELECT 'listing_history date_scraping not_null', count_if(date_scraping IS NULL) FROM history)
SELECT metric, value FROM h"""


def _table_sql(name: str, body: str, key: str, amounts: tuple, count: str) -> str:
    cells = ", ".join(f"CAST({a or 'NULL'} AS DOUBLE) AS {c}" for c, a in zip("abc", amounts))
    return f"SELECT '{name}' AS \"table\", {key} AS key, {cells}, CAST({count} AS BIGINT) AS n FROM ({body})"


def _text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '-')"


def _body(query: str) -> str:
    """A mart's SQL without its WITH clause for the staging rows."""
    return ORACLE_SQL[query].removeprefix(f"WITH {STAGING_SQL}").lstrip(",\n ")


_MEANS = ("avg_price_m2", "avg_rent", "avg_surface")
ORACLE_SQL["refreshed_tables"] = f"""WITH {STAGING_SQL},
seed(seed_rooms, label_typologie) AS (VALUES {_SEED_VALUES}),
t AS ({_body("typology").split(" ORDER BY")[0]}),
daily AS (SELECT city, {_daily('price_m2')} AS p, {_daily('surface_m2')} AS s FROM stg GROUP BY city, date_scraping)
""" + " UNION ALL ".join([
    _table_sql("mart_evolution_prix", _body("price_evolution"), _text("date_scraping"), ("avg_price_m2", "avg_price", None), "nb_annonces"),
    _table_sql("mart_typologie_logement", "SELECT * FROM t", _text("nb_pieces"), _MEANS, "nb_annonces"),
    _table_sql("mart_typologie_libelle", "SELECT t.*, s.label_typologie FROM t LEFT JOIN seed s ON CASE WHEN t.nb_pieces >= 5 THEN 5 ELSE t.nb_pieces END = s.seed_rooms",
               f"{_text('nb_pieces')} || '|' || {_text('label_typologie')}", _MEANS, "nb_annonces"),
    _table_sql("mart_prix_moyen", f"SELECT city, {_over_days('p')} AS avg_price_m2, {_over_days('s')} AS avg_surface_m2, count(*) AS nb_weeks FROM daily GROUP BY city",
               _text("city"), ("avg_price_m2", "avg_surface_m2", None), "nb_weeks"),
    _table_sql("mart_top_annonces", _body("best_deals_20"),
               " || '|' || ".join(_text(c) for c in ("id_annonce", "date_scraping", "title", "city", "description")),
               ("price_m2", "price_eur", "surface_m2"), "1"),
    _table_sql("kpi_marche", _body("market_kpi"), " || '|' || ".join(
        [_text("last_scraping"), _text("CAST(min_price_m2 AS DECIMAL(18,2))"), _text("CAST(max_price_m2 AS DECIMAL(18,2))")]), _MEANS, "total_annonces"),
    _table_sql("persistence_annonces", _body("persistence_top20"), " || '|' || ".join(_text(c) for c in ("id_annonce", "first_seen", "last_seen")),
               _MEANS, "nb_weeks_visible"),
])

ORACLE_SQL["persistence_by_listing_table"] = ORACLE_SQL["persistence"]
ORACLE_SQL["published_history"] = f"""SELECT * FROM ({ORACLE_SQL["gold_from_html"]})
WHERE date_scraping BETWEEN DATE '{PUBLISHED_RANGE[0]}' AND DATE '{PUBLISHED_RANGE[1]}'"""
