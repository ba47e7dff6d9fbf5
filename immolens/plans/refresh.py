"""The refresh job (one snapshot, or a backfill of several).

Order of work, each step a Spark job over files:

    raw pages -> cut-off -> listing extraction -> Silver CSV
    Silver -> Gold (typed, deduplicated) -> History (that date's partition)
    History -> freshness gate -> states of the new snapshots -> marts + KPI, data checks

A date without listings stops the job before Gold, a failed freshness gate
before the marts; failing checks raise, unless ``fail_on_checks`` is off (then
they are reported). Rerunning a date replaces that date in every layer and
nothing else (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from immolens.operators import lattice, marts
from immolens.operators.extract import listings_of, page_links
from immolens.operators.gold import to_gold
from immolens.operators.quality import written_metrics, written_report
from immolens.operators.staging import to_staging
from immolens.sources.files import (
    read_gold, read_history, read_silver, save_table, write_gold, write_history, write_silver,
)
from immolens.plans.states import update_states
from immolens.schema import HISTORY_COLUMNS
from immolens.session import scratch, scratch_folder
from immolens.sources.footers import freshness_of_files
from immolens.sources.pages import END_OF_RESULTS_PATTERN, cut_pages, read_page_metadata, read_page_table, read_pages
from immolens.sources.seed import typology_seed


SILVER_COMPRESSION = "gzip"         # of the jobs' Silver files, which take the most space of all layers
Dates = str | dt.date | tuple[str | dt.date, str | dt.date] | None


@dataclass(frozen=True)
class Layout:
    """Where each layer lives (any Hadoop-compatible URI). With
    ``pages_table`` the pages come from that table instead of ``raw``."""
    raw: str
    silver: str
    gold: str
    history: str
    marts: str
    page_metadata: str | None = None
    pages_table: str | None = None
    states: str | None = None

    @property
    def states_root(self) -> str:
        return self.states or f"{self.marts.rstrip('/')}_states"


@dataclass
class RefreshResult:
    freshness: dict
    checks: list[dict] = field(default_factory=list)
    marts: dict[str, str] = field(default_factory=dict)
    parse_errors: int = 0
    written: dict | None = None           # rows, nulls and checks of the History rows this run wrote
    updated: list = field(default_factory=list)   # snapshots whose History was read


class RefreshError(RuntimeError):
    """A run that was stopped; ``result`` is its report so far."""

    def __init__(self, message: str, result: RefreshResult):
        super().__init__(message)
        self.result = result


class FreshnessError(RefreshError):
    pass


class CheckError(RefreshError):
    pass


class NoListingsError(RuntimeError):
    pass


def pages_to_silver(pages: DataFrame, origin: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver rows of raw pages up to each date's cut-off, and the parse
    errors. The pages are read and parsed once: links and one narrow row per
    page are written to ``folder`` (by default a new one under the shared
    checkpoint folder), and the cut-off and the rows come from there."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "parsed")
    keep = ["snapshot_date", "page_no", "status_code", "source_file"]
    parsed = page_links(pages, keep=keep, end_pattern=END_OF_RESULTS_PATTERN)
    parsed.write.parquet(folder)
    parsed = cut_pages(spark.read.schema(parsed.schema).parquet(folder), F.col("ends"))
    links = parsed.where(F.col("ends").isNull())
    return (listings_of(links, F.lit(origin), carried=["snapshot_date"]),
            links.where(F.col("error").isNotNull()))


@dataclass
class Ingested:
    """What a run of ``ingest`` wrote."""
    dates: list[dt.date]
    parse_errors: int
    written: dict                         # of the History rows, observed while they were written


def _days(dates: Dates) -> str | tuple[str, str] | None:
    if isinstance(dates, tuple):
        return str(dates[0]), str(dates[1])
    return None if dates is None else str(dates)


def ingest(spark: SparkSession, layout: Layout, dates: Dates, origin: str,
           number_style: str = "plain") -> Ingested:
    """Raw pages -> Silver -> Gold -> History for one date, a range of dates
    (first, last) or every date found (None), in one job. Rows, nulls and
    checks of the written History are observed by the write itself."""
    meta = read_page_metadata(spark, layout.page_metadata) if layout.page_metadata else None
    wanted = _days(dates)
    pages = (read_page_table(spark, layout.pages_table, wanted, meta) if layout.pages_table
             else read_pages(spark, layout.raw, wanted, meta))
    with scratch(spark, "parsed") as folder:
        extracted, errors = pages_to_silver(pages, origin, folder)
        write_silver(extracted, layout.silver, compression=SILVER_COMPRESSION)
        # Only the dates of this run are read back; their list is one row a date.
        found = [r[0] for r in extracted.select("snapshot_date").distinct().collect()]
        parse_errors = errors.count()
    if not found and (dates is not None or not _has_rows(read_silver(spark, layout.silver))):
        raise NoListingsError(f"no listings for {dates or 'any date'} under {layout.pages_table or layout.raw}")
    silver = read_silver(spark, layout.silver).where(F.col("snapshot_date").isin(found))
    gold = to_gold(silver, F.col("snapshot_date"), number_style=number_style)
    write_gold(gold, layout.gold)

    history_rows = read_gold(spark, layout.gold, required=False)
    observation = Observation()
    write_history(history_rows.where(F.col("date_scraping").isin(found)), layout.history,
                  observation=observation, metrics=written_metrics(HISTORY_COLUMNS))
    written = written_report(observation.get, HISTORY_COLUMNS, STAGING_TABLE, SOURCE_TABLE)
    return Ingested(sorted(found), parse_errors, written)


def _has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


# Names of the output tables, of the staging view and of the history source.
MART_BUILDERS = {
    "mart_evolution_prix": lambda s, seed: lattice.price_evolution(s.market),
    "mart_typologie_logement": lambda s, seed: lattice.typology(s.market),
    "mart_typologie_libelle": lambda s, seed: lattice.typology_labelled(s.market, seed),
    "mart_prix_moyen": lambda s, seed: lattice.mean_of_snapshot_means(s.market),
    "mart_top_annonces": lambda s, seed: lattice.best_deals(s.price, s.deals),
    "kpi_marche": lambda s, seed: lattice.market_kpi(s.market),
    "persistence_annonces": lambda s, seed: lattice.persistence(s.listing, s.snapshots, limit=20),
}
STAGING_TABLE, SOURCE_TABLE = "stg_listings", "listing_history"


def build_marts(spark: SparkSession, layout: Layout, as_of, fail_on_checks: bool = True,
                percentile_method: str = "exact") -> RefreshResult:
    """History -> freshness gate -> states -> marts -> checks.

    The states (``plans.states``) are brought up to date first: the History of
    new and rewritten snapshots is read, the other snapshots' states are
    merged. Freshness comes from the footers, every mean, indicator and check
    from the same few state rows. ``percentile_method="approx"`` takes the
    best-deals cut from the sketch (``percentile_approx``), over the whole
    History, instead of the exact percentile."""
    fresh = freshness_of_files(spark, layout.history, as_of).first().asDict()
    history = read_history(spark, layout.history)
    return marts_of(spark, history, fresh, layout.states_root, layout.marts, fail_on_checks, percentile_method)


def marts_of(spark: SparkSession, history: DataFrame, fresh: dict, states_root: str, marts_root: str,
             fail_on_checks: bool = True, percentile_method: str = "exact") -> RefreshResult:
    """``build_marts`` for a history that was read from files and whose
    freshness is known."""
    result = RefreshResult(freshness=fresh)
    if fresh["status"] == "error":
        raise FreshnessError(f"history is not fresh: {fresh}", result)

    states = update_states(spark, history, states_root)
    result.updated = states.updated
    seed = typology_seed(spark)
    for name, build in MART_BUILDERS.items():
        path = f"{marts_root.rstrip('/')}/{name}"
        if name == "mart_top_annonces" and percentile_method == "approx":
            table = marts.best_deals(to_staging(history), method="approx")
        else:
            table = build(states, seed)
        save_table(table, path)
        result.marts[name] = path
    report = lattice.check_report(states.market, STAGING_TABLE, SOURCE_TABLE)
    result.checks = [r.asDict() for r in report.collect()]             # a few rows
    failed = [r for r in result.checks if r["status"] != "pass"]
    if failed and fail_on_checks:
        raise CheckError(f"{len(failed)} data checks failed: {failed}", result)
    return result


def refresh(spark: SparkSession, layout: Layout, snapshot_date: Dates,
            origin: str, as_of=None, number_style: str = "plain",
            fail_on_checks: bool = True, percentile_method: str = "exact") -> RefreshResult:
    """R1 (one date) and R2 (backfill: any past date, a range of dates as
    (first, last), or None for all)."""
    done = ingest(spark, layout, snapshot_date, origin, number_style)
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    try:
        result = build_marts(spark, layout, as_of, fail_on_checks, percentile_method)
    except RefreshError as stopped:
        stopped.result.parse_errors, stopped.result.written = done.parse_errors, done.written
        raise
    result.parse_errors, result.written = done.parse_errors, done.written
    return result


def backfill(spark: SparkSession, layout: Layout, origin: str, as_of=None,
             number_style: str = "plain", dates: tuple[str | dt.date, str | dt.date] | None = None) -> RefreshResult:
    """R2: rebuild every date found in the raw layer, or those of a range
    (first, last), in one distributed job."""
    return refresh(spark, layout, dates, origin, as_of, number_style)


def staging_from(spark: SparkSession, layout: Layout) -> DataFrame:
    """The staging view over the history layer."""
    stg = to_staging(read_history(spark, layout.history))
    stg.createOrReplaceTempView("stg_listings")
    return stg


def main(argv: list[str] | None = None) -> None:
    """Command line: ``python -m immolens.plans.refresh --root <uri> --origin <url>
    [--date yyyy-MM-dd|all | --from yyyy-MM-dd --to yyyy-MM-dd]``; on a cluster, ``spark-submit`` this module with the
    package shipped through ``--py-files``."""
    import argparse
    import json

    parser = argparse.ArgumentParser(description="Refresh listing layers and market tables.")
    parser.add_argument("--root", required=True, help="folder holding raw/ silver/ gold/ history/ marts/")
    parser.add_argument("--origin", required=True, help="scheme and host prefixed to listing links")
    parser.add_argument("--date", default=None, help="snapshot date yyyy-MM-dd, or 'all' (default: today, UTC)")
    parser.add_argument("--from", dest="first", default=None, help="first date of a backfill, with --to")
    parser.add_argument("--to", dest="last", default=None, help="last date of a backfill, with --from")
    parser.add_argument("--pages-table", default=None, help="page table (partitioned by snapshot_date) to read instead of raw/")
    parser.add_argument("--page-metadata", default=None, help="JSON lines with source URL, time and status of the pages")
    parser.add_argument("--as-of", default=None, help="freshness reference time (default: now, UTC)")
    parser.add_argument("--number-style", default="plain", choices=["plain", "fr"])
    parser.add_argument("--report-only", action="store_true", help="report failing checks without failing the run")
    parser.add_argument("--percentile", default="exact", choices=["exact", "approx"])
    args = parser.parse_args(argv)
    if bool(args.first) != bool(args.last) or (args.first and args.date):
        parser.error("--from and --to belong together, and not with --date")
    date = args.date or dt.datetime.now(dt.timezone.utc).date().isoformat()
    dates = (args.first, args.last) if args.first else None if date == "all" else date

    spark = SparkSession.builder.appName("immolens-refresh").getOrCreate()
    root = args.root.rstrip("/")
    layout = Layout(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold",
                    history=f"{root}/history", marts=f"{root}/marts", page_metadata=args.page_metadata, pages_table=args.pages_table)
    result = refresh(spark, layout, dates, args.origin, args.as_of, args.number_style,
                     not args.report_only, args.percentile)
    print(json.dumps({"freshness": result.freshness, "checks": result.checks, "marts": result.marts,
                      "parse_errors": result.parse_errors, "written": result.written, "updated": result.updated}, default=str))


if __name__ == "__main__":
    main()
