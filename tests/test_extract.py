"""Golden HTML cases for listing extraction."""

from immolens.operators.extract import extract_listings, parse_listing_links

ORIGIN = "https://listings.example"

WELL_FORMED = """<html><body>
<article>
  <a href="/immobilier/annonce/123/"><img src="a.jpg"></a>
  <a href="/immobilier/annonce/123/" title="Appartement 2 pièces">Appartement 2 pièces</a>
  <span>Rouen (76)</span><span>45 m2</span>
  <p>Bel appartement<br>lumineux</p>
  <div>Loyer : <b>650 €</b> CC</div>
</article>
<nav><a href="/immobilier/annonce/999/" title="Outside">Outside link</a></nav>
<a href="/autre/1/" title="not a listing">x</a>
</body></html>"""

MALFORMED = """<html><body>
<article>
  <a href="/immobilier/annonce/123/"><img src="a.jpg"></a>
  <a href="/immobilier/annonce/123/" title="Appartement 2 pièces">Appartement 2 pièces</a>
  <span>Rouen (76)</span><span>45 m2</span>
  <p>Bel appartement<br>lumineux
  <div>Loyer : <b>650 €</b> CC</div>
</article>
"""


def test_link_selection_and_container():
    links = parse_listing_links(WELL_FORMED)
    # the image link has no title; "/autre/" does not match the prefix
    assert [(l["href"], l["title"]) for l in links] == [
        ("/immobilier/annonce/123/", "Appartement 2 pièces"),
        ("/immobilier/annonce/999/", "Outside"),
    ]
    first, outside = links
    assert first["price"].strip() == "650 €"
    assert first["description"] == "Bel appartement lumineux"
    assert "Rouen (76)" in first["details"] and "650 €" in first["details"]
    # no <article>: the direct parent is the container
    assert outside["details"] == "Outside link"
    assert outside["price"] is None and outside["description"] is None


def test_script_style_and_comments_are_not_visible_text():
    html = ('<article><style>p{}</style><!-- 5 € --><script>var x="99 €";</script>'
            '<template><b>hidden</b></template>'
            '<a href="/immobilier/1" title="t">t</a><p>desc <!-- c --></p><div>650 €</div></article>')
    (link,) = parse_listing_links(html)
    # the price search sees every string node, comments included, in order
    assert link["price"] == " 5 € "
    assert link["details"] == "t desc 650 €"
    assert link["description"] == "desc"


def test_empty_attributes_skipped():
    html = ('<article><a href="/immobilier/1" title="">x</a><a href="" title="t">y</a>'
            '<a title="t">z</a></article>')
    assert parse_listing_links(html) == []
    assert parse_listing_links(None) == []


def test_malformed_page_gives_same_rows(spark):
    good = extract_listings(spark.createDataFrame([("p1.html", WELL_FORMED)], "source_file string, html string"),
                            ORIGIN).where("url like '%/123/'")
    bad = extract_listings(spark.createDataFrame([("p1.html", MALFORMED)], "source_file string, html string"),
                           ORIGIN).where("url like '%/123/'")
    g, b = good.collect(), bad.collect()
    assert len(g) == len(b) == 1
    for col in ["title", "price", "url", "position"]:
        assert g[0][col] == b[0][col]
    assert b[0]["description"].startswith("Bel appartement lumineux")


def test_extract_listings_cleaning(spark):
    html = ("<article><a href='/immobilier/a/7/' title='  Studio  meublé\r\n'>x</a>"
            "<p>Surface 20 m 2\n\n  calme</p></article>"
            "<article><a href='/immobilier/a/8/' title='Sans rien'>x</a></article>")
    df = spark.createDataFrame([("raw/2025-02-01/page_1.html", html)], "source_file string, html string")
    out = extract_listings(df, ORIGIN).collect()
    assert len(out) == 1                        # the second has neither price nor description
    r = out[0]
    assert r["title"] == "Studio meublé"
    assert r["description"] == "Surface 20 m² calme"
    assert r["price"] is None
    assert r["url"] == ORIGIN + "/immobilier/a/7/"
    assert r["source_file"] == "raw/2025-02-01/page_1.html"
    assert r["position"] == 1


def test_m2_sup_and_entities():
    html = ('<article><a href="/immobilier/1" title="t">t</a><p>45 m<sup>2</sup> &amp; balcon</p>'
            '<span>1&nbsp;250 €</span></article>')
    (link,) = parse_listing_links(html)
    assert link["description"] == "45 m 2 & balcon"      # cleaned to "45 m² & balcon" later
    assert link["price"] == "1 250 €"


def test_bad_link_is_isolated(monkeypatch):
    import immolens.operators.extract as ex
    calls = {"n": 0}
    real = ex._LinkEvents._fields

    def flaky(self, container):
        calls["n"] += 1
        if calls["n"] == 1:
            raise ValueError("boom")
        return real(self, container)

    monkeypatch.setattr(ex._LinkEvents, "_fields", flaky)
    html = ('<article><a href="/immobilier/1" title="a">a</a><p>one</p></article>'
            '<article><a href="/immobilier/2" title="b">b</a><p>two</p></article>')
    links = ex.parse_listing_links(html)
    assert links[0]["error"] is not None
    assert links[1]["error"] is None and links[1]["description"] == "two"


def test_image_and_title_links_two_silver_rows_one_gold_row(spark):
    from pyspark.sql import functions as F
    from immolens.operators.gold import to_gold
    html = ('<article><a href="/immobilier/a/42/" title="Appartement 2 pièces"><img src="x.jpg"></a>'
            '<a href="/immobilier/a/42/" title="Appartement 2 pièces">Appartement 2 pièces</a>'
            '<span>Rouen (76) 45 m<sup>2</sup></span><p>Calme</p><b>650 €</b></article>')
    pages = spark.createDataFrame([("raw/2025-02-01/page_1.html", html)], "source_file string, html string")
    silver = extract_listings(pages, ORIGIN)
    rows = silver.orderBy("position").collect()
    assert [r["position"] for r in rows] == [1, 2]
    assert "45 m²" in rows[0]["details"]
    gold = to_gold(silver, "2025-02-01").collect()
    assert len(gold) == 1
    g = gold[0]
    assert (g["id_annonce"], g["price_eur"], g["surface_m2"], g["nb_pieces"], g["city"], g["price_m2"]) == \
        ("42", 650, 45, 2, "Rouen", 14.44)


def test_many_links_in_one_container_is_linear():
    import time
    links = "".join(f'<li><a href="/immobilier/{i}" title="t{i}">x</a></li>' for i in range(4000))
    html = f"<article><ul>{links}</ul><p>desc</p><div>500 €</div></article>"
    t0 = time.perf_counter()
    out = parse_listing_links(html)
    assert time.perf_counter() - t0 < 5
    assert len(out) == 4000 and out[-1]["price"] == "500 €" and out[0]["description"] == "desc"


def test_unclosed_and_unmatched_tags_stay_linear():
    import time
    html = ("<div>" * 20000) + ("</b>" * 20000) + \
        '<article><a href="/immobilier/1" title="t">t</a><p>d</p></article>' * 2000
    t0 = time.perf_counter()
    out = parse_listing_links(html)
    assert time.perf_counter() - t0 < 10
    assert len(out) == 2000 and out[0]["details"] == "t d"


def test_cdata_is_text():
    html = '<article><a href="/immobilier/1" title="t">t</a><p><![CDATA[45 m2]]> calme</p></article>'
    (link,) = parse_listing_links(html)
    assert link["description"] == "45 m2 calme"


def test_text_is_one_string_up_to_the_next_tag():
    from immolens.operators.extract import parse_listing_links
    row, = parse_listing_links('<article><a href="/immobilier/1" title="t">t</a><div>prix<500 €</div></article>')
    assert row["price"] == "prix<500 €" and row["details"] == "t prix<500 €"


def test_rejected_markup_is_one_error_row():
    from immolens.operators.extract import parse_listing_links
    row, = parse_listing_links('<a href="/immobilier/1" title="t">t</a><![foo[x]]>')
    assert row["position"] == 0 and row["href"] is None and row["error"]
