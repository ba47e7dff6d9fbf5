"""Silver -> Gold (G1-G13), history (H1-H4) and staging (V1-V6) fixtures."""

import datetime as dt

from immolens.operators.gold import dedupe_first, to_gold
from immolens.operators.history import (
    history_stats, normalize_snapshot_date, rows_per_snapshot, union_snapshots,
)
from immolens.operators.staging import to_staging
from immolens.schema import GOLD_COLUMNS, SILVER

D = dt.date(2025, 2, 1)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def gold_row(gold, id_):
    return [r for r in gold.collect() if r["id_annonce"] == id_][0]


def test_to_gold_fields(spark):
    s = silver(spark, [
        ("Appartement 3 Pièces ", "T3 45 m² Rouen (76)", "650 €", "Calme\r\n\nlumineux",
         "https://x/immobilier/a/123/", "p1", 1),
        ("Studio", "20 m² Mont-Saint-Aignan (76)", "1 250 €", None, "https://x/a/55", "p1", 2),
        ("Maison", None, "abc", "d", "ftp://x/a/9", "p1", 3),
        ("Maison", None, None, "d", None, "p1", 4),
        ("T2", "40 m² sans ville", None, "d", "https://x/?q=1", "p1", 5),
    ])
    g = to_gold(s, "2025-02-01")
    assert g.columns == GOLD_COLUMNS
    assert g.count() == 3                      # ftp and null url dropped
    r = gold_row(g, "123")
    assert (r["title"], r["price_eur"], r["surface_m2"], r["nb_pieces"], r["price_m2"], r["city"],
            r["description"], r["date_scraping"]) == \
        ("Appartement 3 Pièces", 650, 45, 3, 14.44, "Rouen", "Calme lumineux", D)
    r = gold_row(g, "55")
    assert (r["price_eur"], r["surface_m2"], r["nb_pieces"], r["city"]) == (250, 20, None, "Aignan")
    r = gold_row(g, "?q=1")
    assert (r["price_eur"], r["price_m2"], r["city"]) == (None, None, "Rouen")


def test_to_gold_fr_numbers(spark):
    s = silver(spark, [("T2", "45,5 m²", "1 250 €", "d", "https://x/a/1/", "p", 1)])
    r = to_gold(s, D, number_style="fr").collect()[0]
    assert (r["price_eur"], r["surface_m2"], r["price_m2"]) == (1250, 45, 27.78)


def test_dedupe_keeps_first_by_file_and_position(spark):
    s = silver(spark, [
        ("second", "10 m²", "500 €", "d", "https://x/a/1/", "page_1", 7),
        ("first", "10 m²", "400 €", "d", "https://x/a/1", "page_1", 2),
        ("other file", "10 m²", "300 €", "d", "https://x/a/1/", "page_2", 1),
        ("alone", "10 m²", "300 €", "d", "https://x/a/2/", "page_2", 1),
    ])
    g = to_gold(s, D)
    assert g.count() == 2
    assert gold_row(g, "1")["title"] == "first"


def test_image_and_title_link_give_one_gold_row(spark):
    s = silver(spark, [
        ("Appartement", "x 30 m²", "600 €", None, "https://x/immobilier/7/", "p", 1),
        ("Appartement", "x 30 m²", "600 €", None, "https://x/immobilier/7/", "p", 2),
    ])
    assert to_gold(s, D).count() == 1


def test_dedupe_hot_key_is_combined_before_shuffle(spark):
    df = spark.range(0, 20000).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS k", "id AS o", "id * 2 AS v")
    out = dedupe_first(df, ["k"], ["o"])
    assert [tuple(r) for r in out.where("k = 'hot'").collect()] == [("hot", 0, 0)] and out.count() == 13334
    plan = out._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_history_keeps_every_snapshot_row(spark):
    g1 = to_gold(silver(spark, [("A", "30 m²", "600 €", "d", "https://x/a/1/", "p", 1)]), "2025-02-01")
    g2 = to_gold(silver(spark, [("A", "30 m²", "610 €", "d", "https://x/a/1/", "p", 1)]), "2025-02-08")
    g3 = to_gold(silver(spark, [("A", "30 m²", "620 €", "d", "https://x/a/1/", "p", 1)]), "2025-02-15")
    h = union_snapshots(g1, g2, g3, g1)           # identical snapshot twice: all rows kept
    assert h.count() == 4
    st = history_stats(h).collect()[0]
    assert (st["total_rows"], st["distinct_ids"], st["distinct_dates"]) == (4, 1, 3)
    per = [tuple(r) for r in rows_per_snapshot(h).collect()]
    assert per == [(dt.date(2025, 2, 1), 2), (dt.date(2025, 2, 8), 1), (dt.date(2025, 2, 15), 1)]


def test_history_stats_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", D), (None, D), (None, None)], "id_annonce string, date_scraping date")
    st = history_stats(df).collect()[0]
    assert (st["total_rows"], st["distinct_ids"], st["distinct_dates"]) == (3, 2, 2)


def test_text_dates_are_normalised(spark):
    df = spark.createDataFrame([("2025-02-01",), ("01-02-2025",), ("x",)], "date_scraping string")
    assert [r[0] for r in normalize_snapshot_date(df).collect()] == [D, D, None]


def history(spark, rows):
    return spark.createDataFrame(rows, "id_annonce string, title string, price_eur int, surface_m2 int, "
                                       "nb_pieces int, price_m2 double, city string, description string, "
                                       "url string, date_scraping date")


def test_staging_casts_filters_and_recomputes(spark):
    h = history(spark, [
        ("1", "BEL APPART", 650, 40, 2, 99.0, "ROUEN", "  calme ", "u", D),
        ("2", "x", None, 40, 2, None, "r", "d", "u", D),
        ("3", "x", 650, 0, 2, None, "r", "d", "u", D),
        ("4", "x", 650, None, 2, None, "r", "d", "u", D),
    ])
    out = to_staging(h).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["title"], r["city"], r["price_eur"], r["surface_m2"], r["price_m2"], r["description"]) == \
        ("Bel appart", "Rouen", 650.0, 40.0, 16.25, "calme")       # Gold's 99.0 is ignored
    assert "url" not in to_staging(h).columns


def test_staging_epoch_day_dates(spark):
    h = spark.createDataFrame([("1", "t", 500, 20, 1, None, "c", "d", "u", 20000)],
                              "id_annonce string, title string, price_eur int, surface_m2 int, nb_pieces int, "
                              "price_m2 double, city string, description string, url string, date_scraping int")
    assert to_staging(h).collect()[0]["date_scraping"] == dt.date(2024, 10, 4)
