"""Files in, files out: pages, Silver CSV, Gold/History Parquet, the
refresh job and its idempotence (S1-S12, H5, R1-R2)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from immolens.plans.refresh import FreshnessError, Layout, refresh
from immolens.schema import SILVER
from immolens.sources.files import read_gold, read_history, read_silver, write_gold, write_silver
from immolens.sources.pages import read_page_metadata, read_pages, take_until_end

ORIGIN = "https://listings.example"


def listing(i, price, surface, rooms, city="Rouen"):
    return (f'<article><a href="/immobilier/location/{i}/" title="Appartement {rooms} pièces">'
            f'Appartement</a><span>{city} (76)</span><span>{surface} m2</span>'
            f'<p>Annonce {i}</p><div>{price} €</div></article>')


def write_page(root, date, n, body, raw=False):
    folder = os.path.join(root, date)
    os.makedirs(folder, exist_ok=True)
    data = body if raw else f"<html><body>{body}</body></html>".encode()
    with open(os.path.join(folder, f"page_{n}.html"), "wb") as fh:
        fh.write(data)


def test_read_pages_decodes_and_numbers(spark, tmp_dir):
    write_page(tmp_dir, "2025-02-01", 1, b"<p>caf\xc3\xa9 \xff ok</p>", raw=True)
    write_page(tmp_dir, "2025-02-01", 10, "x")
    write_page(tmp_dir, "2025-02-01", 2, "y")
    pages = read_pages(spark, tmp_dir, "2025-02-01").orderBy("page_no").collect()
    assert [p["page_no"] for p in pages] == [1, 2, 10]
    assert pages[0]["html"] == "<p>café  ok</p>"
    assert pages[0]["snapshot_date"] == dt.date(2025, 2, 1)
    assert read_pages(spark, tmp_dir, "2030-01-01").count() == 0
    write_page(tmp_dir, "not-a-date", 1, "x")
    assert read_pages(spark, tmp_dir).count() == 3


def test_take_until_end(spark, tmp_dir):
    write_page(tmp_dir, "2025-02-01", 1, "10 annonces")
    write_page(tmp_dir, "2025-02-01", 2, "0 annonce trouvée")
    write_page(tmp_dir, "2025-02-01", 3, "more")
    write_page(tmp_dir, "2025-02-08", 1, "a")
    write_page(tmp_dir, "2025-02-08", 2, "b")
    write_page(tmp_dir, "2025-02-08", 3, "c")
    meta_path = os.path.join(tmp_dir, "meta.jsonl")
    with open(meta_path, "w") as fh:
        for d, n, s in [("2025-02-08", 1, 200), ("2025-02-08", 2, 503), ("2025-02-08", 3, 200)]:
            fh.write(json.dumps({"snapshot_date": d, "page_no": n, "status_code": s,
                                 "source_url": "u", "user_agent": "A" * 300}) + "\n")
    pages = read_pages(spark, tmp_dir, metadata=read_page_metadata(spark, meta_path))
    kept = sorted((str(r["snapshot_date"]), r["page_no"]) for r in take_until_end(pages).collect())
    assert kept == [("2025-02-01", 1), ("2025-02-01", 2), ("2025-02-08", 1)]
    assert max(len(r["user_agent"] or "") for r in pages.collect()) == 250


def test_silver_csv_round_trip_with_quotes_and_newlines(spark, tmp_dir):
    rows = [('Appart "cosy", Rouen', "a\nb", "650 €", None, "https://x/a/1/", "f", 1)]
    df = spark.createDataFrame(rows, SILVER).withColumn("snapshot_date", F.lit("2025-02-01").cast("date"))
    write_silver(df, tmp_dir)
    back = read_silver(spark, tmp_dir, "2025-02-01").collect()
    assert back[0]["title"] == 'Appart "cosy", Rouen' and back[0]["details"] == "a\nb"


def test_silver_csv_written_by_pandas_with_bom(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "snapshot_date=2025-02-01")
    os.makedirs(folder)
    text = ('title,details,price,description,url,source_file,position\n'
            '"Appart ""cosy"", Rouen",d,650 €,,https://x/a/1/,f,3000000000\n')
    with open(os.path.join(folder, "part.csv"), "wb") as fh:
        fh.write(text.encode("utf-8-sig"))
    back = read_silver(spark, tmp_dir).collect()
    assert len(back) == 1 and back[0]["title"] == 'Appart "cosy", Rouen' and back[0]["url"] == "https://x/a/1/"
    assert back[0]["position"] == 3_000_000_000


def test_damaged_silver_fails_the_read(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "snapshot_date=2025-02-01")
    os.makedirs(folder)
    for k, line in enumerate(["T,d,650 €,,https://x/a/1/,f,not-a-number", "T,d,650 €"]):
        with open(os.path.join(folder, "part.csv"), "w", encoding="utf-8") as fh:
            fh.write("title,details,price,description,url,source_file,position\n" + line + "\n")
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|CAST"):
            read_silver(spark, tmp_dir).collect()


def test_silver_file_without_a_date_in_its_name(spark, tmp_dir):
    from immolens.sources.files import read_dated_silver_files
    for name in ("export.csv", "2025-02-08.csv", "2025-13-45.csv"):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as fh:
            fh.write("title,details,price,description,url,source_file\nT,d,650 €,,https://x/a/1/,f\n")
    rows = read_dated_silver_files(spark, tmp_dir, default_date="2025-03-01").collect()
    assert sorted(str(r["snapshot_date"]) for r in rows) == ["2025-02-08", "2025-03-01", "2025-03-01"]
    with pytest.raises(Exception, match="no date in the file name"):
        read_dated_silver_files(spark, tmp_dir).collect()


def test_pages_without_a_number_and_folders_without_a_date(spark, tmp_dir):
    from immolens.sources.pages import read_pages, take_until_end
    for day, name, html in (("2025-02-01", "page_1", "10 annonces"), ("2025-02-01", "listing-2", "x"), ("2025-02-01", "page_3", "Aucune annonce"),
                            ("2025-02-01", "page_4", "late"), ("2025-13-45", "page_1", "y")):
        os.makedirs(f"{tmp_dir}/{day}", exist_ok=True)
        with open(f"{tmp_dir}/{day}/{name}.html", "w", encoding="utf-8") as fh:
            fh.write(html)
    kept = take_until_end(read_pages(spark, tmp_dir)).collect()
    assert sorted(os.path.basename(r["source_file"]) for r in kept) == ["listing-2.html", "page_1.html", "page_3.html"]


def test_a_broken_page_does_not_stop_the_job(spark, tmp_dir):
    write_page(f"{tmp_dir}/raw", "2025-02-02", 1, listing(1, 650, 40, 2))
    write_page(f"{tmp_dir}/raw", "2025-02-02", 2, listing(2, 700, 50, 2) + "<![foo[x]]>")
    res = refresh(spark, layout(tmp_dir), "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
    assert res.parse_errors == 1
    assert spark.read.parquet(res.marts["kpi_marche"]).collect()[0]["total_annonces"] == 1


def test_gold_requires_input(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "gold"))
    with pytest.raises(FileNotFoundError):
        read_gold(spark, os.path.join(tmp_dir, "gold"))


def test_partition_overwrite_is_idempotent(spark, tmp_dir):
    from immolens.operators.gold import to_gold
    s = spark.createDataFrame([("A", "30 m²", "600 €", "d", "https://x/a/1/", "p", 1)], SILVER)
    for d in ("2025-02-01", "2025-02-08", "2025-02-08"):
        write_gold(to_gold(s, d), tmp_dir)
    g = read_gold(spark, tmp_dir)
    assert g.count() == 2


def build_raw(root):
    week1 = [listing(1, 650, 40, 2), listing(2, 900, 60, 3), listing(2, 900, 60, 3)]
    week2 = [listing(1, 660, 40, 2), listing(3, 400, 18, 1, "Darnetal")]
    write_page(root, "2025-02-02", 1, "".join(week1))
    write_page(root, "2025-02-02", 2, "Aucune annonce")
    write_page(root, "2025-02-02", 3, listing(99, 1, 1, 1))           # after the end: ignored
    write_page(root, "2025-02-09", 1, "".join(week2))


def layout(root):
    return Layout(raw=f"{root}/raw", silver=f"{root}/silver", gold=f"{root}/gold",
                  history=f"{root}/history", marts=f"{root}/marts")


def test_refresh_end_to_end_and_rerun(spark, tmp_dir):
    build_raw(f"{tmp_dir}/raw")
    lay = layout(tmp_dir)
    as_of = dt.datetime(2025, 2, 10, 12)
    refresh(spark, lay, "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
    res = refresh(spark, lay, dt.date(2025, 2, 9), ORIGIN, as_of=as_of)
    assert res.freshness["status"] == "pass"
    hist = read_history(spark, lay.history)
    assert hist.count() == 4                       # 2 + 2; duplicate link collapsed; page 3 ignored
    first = spark.read.parquet(res.marts["mart_evolution_prix"]).orderBy("date_scraping").collect()
    assert [(r["date_scraping"], r["nb_annonces"]) for r in first] == \
        [(dt.date(2025, 2, 2), 2), (dt.date(2025, 2, 9), 2)]
    checks = {(r["table"], r["column"], r["check"]): r["status"] for r in res.checks}
    assert checks[("stg_listings", "surface_m2", "between[5,]")] == "pass"
    # rerunning a date changes nothing
    again = refresh(spark, lay, "2025-02-09", ORIGIN, as_of=as_of)
    assert read_history(spark, lay.history).count() == 4
    second = spark.read.parquet(again.marts["mart_evolution_prix"]).orderBy("date_scraping").collect()
    assert first == second
    cities = {r["city"] for r in spark.read.parquet(again.marts["mart_prix_moyen"]).collect()}
    assert cities == {"Rouen", "Darnetal"}


def test_backfill_all_dates_then_stale_history(spark, tmp_dir):
    build_raw(f"{tmp_dir}/raw")
    lay = layout(tmp_dir)
    refresh(spark, lay, None, ORIGIN, as_of=dt.datetime(2025, 2, 10))
    assert read_history(spark, lay.history).count() == 4
    with pytest.raises(FreshnessError):
        refresh(spark, lay, None, ORIGIN, as_of=dt.datetime(2025, 3, 1))


def test_silver_one_csv_per_date(spark, tmp_dir):
    from immolens.operators.gold import to_gold
    from immolens.sources.files import read_dated_silver_files
    for date, price in (("2025-02-01", 600), ("2025-02-08", 610)):
        text = ('title,details,price,description,url,source_file\n'
                f'"Appart ""cosy"", 2 pièces","T2 40 m² Rouen (76)",{price} €,"ligne 1\nligne 2",'
                f'https://x/immobilier/a/1/,raw/{date}/page_1.html\n')
        with open(os.path.join(tmp_dir, f"{date}.csv"), "wb") as fh:
            fh.write(text.encode("utf-8-sig"))
    silver = read_dated_silver_files(spark, os.path.join(tmp_dir, "*.csv"))
    got = sorted((str(r["snapshot_date"]), r["title"], r["description"]) for r in silver.collect())
    assert got == [("2025-02-01", 'Appart "cosy", 2 pièces', "ligne 1\nligne 2"),
                   ("2025-02-08", 'Appart "cosy", 2 pièces', "ligne 1\nligne 2")]
    gold = to_gold(silver, F.col("snapshot_date")).orderBy("date_scraping").collect()
    assert [(r["price_eur"], r["price_m2"], r["nb_pieces"]) for r in gold] == [(600, 15.0, 2), (610, 15.25, 2)]


def test_gold_files_with_text_dates(spark, tmp_dir):
    from immolens.sources.files import read_text_dated_gold_files
    from immolens.schema import GOLD
    import pyspark.sql.types as T
    schema = T.StructType([f if f.name != "date_scraping" else T.StructField(f.name, T.StringType())
                           for f in GOLD.fields])
    for name, date in (("2025-02-01_clean.parquet", "2025-02-01"), ("2025-02-08_clean.parquet", "08-02-2025")):
        spark.createDataFrame([("1", "t", 600, 40, 2, 15.0, "Rouen", "d", "https://x/1/", date)], schema) \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(tmp_dir, name))
    g = read_text_dated_gold_files(spark, os.path.join(tmp_dir, "*_clean.parquet"))
    assert sorted(str(r["date_scraping"]) for r in g.collect()) == ["2025-02-01", "2025-02-08"]
    with pytest.raises(Exception):
        read_text_dated_gold_files(spark, os.path.join(tmp_dir, "nothing_*.parquet")).count()


def test_history_as_external_table(spark, tmp_dir):
    from immolens.operators.gold import to_gold
    from immolens.sources.files import register_history
    s = spark.createDataFrame([("A", "30 m²", "600 €", "d", "https://x/a/1/", "p", 1)], SILVER)
    for d in ("2025-02-01", "2025-02-08"):
        write_gold(to_gold(s, d), tmp_dir)
    t = register_history(spark, tmp_dir, name="listing_history_ext", external=True)
    assert t.count() == 2
    assert spark.sql("SELECT count(DISTINCT date_scraping) FROM listing_history_ext").collect()[0][0] == 2


def test_cut_at_first_with_a_hot_group(spark):
    import random
    from immolens.operators.cutoff import cut_at_first
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 50), i, rng.choice(["view", "view", "error"]))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "user_id long, ts long, event_type string")
    got = sorted(tuple(r) for r in cut_at_first(df, ["user_id"], ["ts"], F.col("event_type") == "error").collect())
    want, stopped = [], set()
    for u, t, e in sorted(rows, key=lambda r: (r[0], r[1])):
        if u in stopped:
            continue
        want.append((u, t, e))
        if e == "error":
            stopped.add(u)
    assert got == sorted(want)


def test_a_date_without_pages_stops_the_job(spark, tmp_dir):
    from immolens.plans.refresh import NoListingsError
    os.makedirs(f"{tmp_dir}/raw")
    with pytest.raises(NoListingsError):
        refresh(spark, layout(tmp_dir), "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
    write_page(f"{tmp_dir}/raw", "2025-02-02", 1, listing(1, 650, 40, 2))
    res = refresh(spark, layout(tmp_dir), "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
    written = sorted(os.listdir(res.marts["kpi_marche"]))
    with pytest.raises(NoListingsError):
        refresh(spark, layout(tmp_dir), "2025-02-04", ORIGIN, as_of=dt.datetime(2025, 2, 4))
    assert sorted(os.listdir(res.marts["kpi_marche"])) == written        # no mart was touched


def test_page_metadata_reaches_the_cut_off(spark, tmp_dir):
    import dataclasses
    import json as _json
    for n in (1, 2, 3):
        write_page(f"{tmp_dir}/raw", "2025-02-02", n, listing(n, 650, 40, 2))
    with open(f"{tmp_dir}/meta.json", "w", encoding="utf-8") as fh:
        for n, status in ((1, 200), (2, 503), (3, 200)):
            fh.write(_json.dumps({"snapshot_date": "2025-02-02", "page_no": n, "status_code": status}) + "\n")
    lay = dataclasses.replace(layout(tmp_dir), page_metadata=f"{tmp_dir}/meta.json")
    res = refresh(spark, lay, "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
    assert spark.read.parquet(res.marts["kpi_marche"]).collect()[0]["total_annonces"] == 1


def test_command_line_entry(spark, tmp_dir, capsys):
    import json as _json
    from immolens.plans.refresh import main
    build_raw(f"{tmp_dir}/raw")
    main(["--root", tmp_dir, "--origin", ORIGIN, "--as-of", "2025-02-10 00:00:00", "--percentile", "approx",
          "--date", "all"])
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["freshness"]["status"] == "pass"
    assert set(out["marts"]) >= {"mart_prix_moyen", "kpi_marche", "mart_top_annonces"}
    assert spark.read.parquet(out["marts"]["kpi_marche"]).collect()[0]["total_annonces"] == 4


def test_refresh_from_files_equals_in_memory_path(spark, tmp_dir):
    """Pages built from the tables, written as files, go through the whole
    refresh job; its evolution mart equals the in-memory (oracle-checked)
    path over the same pages."""
    from immolens.operators import marts as M
    from immolens.operators.staging import to_staging
    from immolens.plans.adapters import PAGE_ORIGIN, listing_pages_from_tables
    from immolens.plans.catalog import QUERIES
    sf = "/root/testdata/sf0.001"
    for r in listing_pages_from_tables(spark, sf).toLocalIterator():
        write_page(f"{tmp_dir}/raw", str(r["snapshot_date"]), r["page_no"], r["html"].encode(), raw=True)
    res = refresh(spark, layout(tmp_dir), None, PAGE_ORIGIN, as_of=dt.datetime(2001, 10, 30), fail_on_checks=False)
    got = [tuple(r) for r in spark.read.parquet(res.marts["mart_evolution_prix"]).orderBy("date_scraping").collect()]
    want = [tuple(r) for r in M.price_evolution(to_staging(QUERIES["gold_from_html"](spark, sf))).collect()]
    assert got == want and len(got) > 100


def test_seed_csv_source(spark, tmp_dir):
    from immolens.sources.seed import TYPOLOGY_ROWS, read_seed
    path = os.path.join(tmp_dir, "seed.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("nb_pieces,label_typologie,description\n")
        for n, label, desc in TYPOLOGY_ROWS:
            fh.write(f'{n},{label},"{desc}"\n')
    assert sorted(tuple(r) for r in read_seed(spark, path).collect()) == sorted(TYPOLOGY_ROWS)


def test_single_file_history_export(spark, tmp_dir):
    from immolens.operators.gold import to_gold
    from immolens.sources.files import write_history
    s = spark.createDataFrame([("A", "30 m²", "600 €", "d", "https://x/a/1/", "p", 1),
                               ("B", "40 m²", "700 €", "d", "https://x/a/2/", "p", 2)], SILVER)
    out = os.path.join(tmp_dir, "history_export")
    write_history(to_gold(s, "2025-02-01").unionByName(to_gold(s, "2025-02-08")), out, single_file=True)
    parts = [f for f in os.listdir(out) if f.endswith(".parquet")]
    assert len(parts) == 1
    assert spark.read.parquet(out).count() == 4


def test_failing_checks_are_reported_and_can_stop_the_job(spark, tmp_dir):
    from immolens.plans.refresh import CheckError
    write_page(f"{tmp_dir}/raw", "2025-02-02", 1, listing(1, 650, 40, 2) + listing(2, 300, 4, 1))
    res = refresh(spark, layout(tmp_dir), "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3), fail_on_checks=False)
    failed = [(r["column"], r["check"], r["failures"]) for r in res.checks if r["status"] == "fail"]
    assert failed == [("surface_m2", "between[5,]", 1)]
    with pytest.raises(CheckError):
        refresh(spark, layout(tmp_dir), "2025-02-02", ORIGIN, as_of=dt.datetime(2025, 2, 3))
