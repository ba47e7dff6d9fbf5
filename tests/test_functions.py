import datetime as dt

from pyspark.sql import functions as F

from immolens.functions import (
    PRICE_PATTERN, ROOMS_PATTERN, SURFACE_PATTERN, capitalize_first, clean_text,
    collapse_newlines, epoch_day_to_date, extract_city, extract_fr_int, extract_int,
    is_http_url, listing_id, price_per_m2, round2, tolerant_date,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_text(spark):
    got = one_col(spark, [None, "", "  a\r\nb  ", "45 m2", "45 m 2", "a  b\tc", "   "],
                  clean_text)
    assert got == [None, None, "a b", "45 m²", "45 m²", "a b c", ""]


def test_clean_text_square_metres_and_unicode_blanks(spark):
    samples = ["x\u00a0y\u3000z", "\x1cq\x85r", " lead and trail ", "m2m 2\nm2", "m\n2", "45\tm2"]
    assert one_col(spark, samples, clean_text) == ["x y z", "q r", "lead and trail", "m²m² m²", "m²", "45 m²"]


def test_collapse_newlines_and_capitalize(spark):
    assert one_col(spark, ["a\r\n\r\nb\nc", None], collapse_newlines) == ["a b c", None]
    assert one_col(spark, ["BEL APPART", "rouen", "", None], capitalize_first) == \
        ["Bel appart", "Rouen", "", None]


def test_extract_numbers(spark):
    assert one_col(spark, ["650 €", "1 250 €", "abc", None, "99999999999 €"],
                   lambda c: extract_int(c, PRICE_PATTERN)) == [650, 250, None, None, None]
    assert one_col(spark, ["T2 45 m²", "45,5 m²", "no unit"],
                   lambda c: extract_int(c, SURFACE_PATTERN)) == [45, 5, None]
    assert one_col(spark, ["Appartement 3 Pièces", "Studio"],
                   lambda c: extract_int(F.lower(c), ROOMS_PATTERN)) == [3, None]


def test_extract_numbers_fr_style(spark):
    assert one_col(spark, ["1 250 €", "1 250 €", "650 €"],
                   lambda c: extract_fr_int(c, "€")) == [1250, 1250, 650]
    assert one_col(spark, ["45,5 m²", "T2 45 m²"], lambda c: extract_fr_int(c, "m²")) == [45, 45]


def test_city(spark):
    got = one_col(spark, ["Appartement Rouen (76)", "nothing here", None, "Mont-Saint-Aignan (76)",
                          "Le Petit-Quevilly (76)"], extract_city)
    assert got == ["Rouen", "Rouen", "Rouen", "Aignan", "Quevilly"]


def test_listing_id_and_url_filter(spark):
    assert one_col(spark, ["https://x/a/b/123/", "https://x/?q=1", "https://x/a/9"], listing_id) == \
        ["123", "?q=1", "9"]
    assert one_col(spark, ["ftp://x", None, "http://a", "https://b"], is_http_url) == \
        [False, None, True, True]


def test_price_per_m2(spark):
    df = spark.createDataFrame([(650, 40), (650, 0), (None, 40), (100, None), (1005, 1000)],
                               "p int, s int")
    got = [r[0] for r in df.select(price_per_m2("p", "s")).collect()]
    assert got == [16.25, None, None, None, 1.01]


def test_round2_half_up_on_decimal_value(spark):
    assert one_col(spark, [1.005, 2.675, -1.005, 0.0], round2, "double") == [1.01, 2.68, -1.01, 0.0]


def test_dates(spark):
    assert one_col(spark, ["2025-02-01", "01-02-2025", "x", None], tolerant_date) == \
        [dt.date(2025, 2, 1), dt.date(2025, 2, 1), None, None]
    assert one_col(spark, [20000, 0], epoch_day_to_date, "int") == \
        [dt.date(2024, 10, 4), dt.date(1970, 1, 1)]


def test_rounding_happens_once(spark):
    from immolens.functions import mean2, round2
    df = spark.createDataFrame([(1.0049999997, 1.0), (1e13, 2.0), (1.005, 3.0), (None, 4.0)], "x double, k double")
    assert [r[0] for r in df.orderBy("k").select(round2("x")).collect()] == [1.0, 1e13, 1.01, None]
    means = spark.createDataFrame([(1.0,), (1.01,), (None,), (1e13,)], "x double")
    assert means.where("x < 2").agg(mean2("x")).first()[0] == 1.01            # half a cent goes up
    assert means.agg(mean2("x")).first()[0] == round((1.0 + 1.01 + 1e13) / 3, 2)
    assert means.where("x < 0").agg(mean2("x")).first()[0] is None
