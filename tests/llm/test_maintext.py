"""Main text of pages: planted articles, awkward markup, whole tables."""

import re
from html import unescape

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.llm import catalog
from immolens.llm.maintext import content_cluster, page_text, with_main_text

SF = "/root/testdata/sf0.01"
LONG = "A sentence of the article with a good many words in it, as articles have, and then a few more of them. "
PARAGRAPHS = ["The title of it", LONG * 2, "Short.", LONG, "&amp; so &eacute;t&eacute;", LONG * 3]
EXPECTED = "\n".join(" ".join(unescape(p).split()) for p in PARAGRAPHS)
BODY = f"<h1>{PARAGRAPHS[0]}</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS[1:])
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(8)) + "</ul>"


@pytest.mark.parametrize("html", [
    f"<html><head><title>T</title></head><body><nav>{MENU}</nav><article>{BODY}</article><footer>{LONG}</footer></body></html>",
    f"<body><header><div>{LONG}</div></header><main><article>{BODY}</article><aside>{LONG}</aside></main></body>",
    f"<body><form action=x><div class='cookie-notice'>{LONG}</div><article>{BODY}</article></form></body>",
    f"<body><article>{BODY}<section id='comments'><article><p>{LONG * 6}</p></article></section></article></body>",
    f"<body><article>{BODY}<div class=advert>{LONG}</div><form><p>{LONG}</p></form><script>var a='{LONG}</p>'</script></article></body>",
    f"<body><div id=sidebar>{MENU}</div><div class=content>{BODY}</div><div class=footer><p>{LONG}</p></div></body>",
    f"<body><div class='page has-sidebar'><main>{BODY}</main></div><div class=reader-comments><p>{LONG * 9}</p></div></body>",
    f"<body>{MENU}<div><div>{BODY}</div></div>{MENU}</body>",
    f"<article>{BODY}</article><article class=teaser><a href=x>Other</a><p>Teaser.</p></article>",
    f"<ARTICLE>{BODY}<STYLE>p{{}}</STYLE><p hidden>{LONG}</p><!-- {LONG} --><p class=ad>{LONG}<p></ARTICLE>",
    f"<article>{BODY}</article><footer>cut &copy; of",
    f"<article>{BODY}</article><footer><a href='",
    f"<article>{BODY}<![foo[x]]><![CDATA[y]]><!bogus></article><p <!-- ",
], ids=range(13))
def test_planted_article(html):
    assert page_text(html) == EXPECTED


def test_inline_markup_and_white_space():
    html = "<article><p>a<b>b</b>  c\n\t&nbsp;d<br>e<i> f</i></p>g<ul><li>h<li>i</ul><p></p></article>"
    assert page_text(html) == "ab c d e f\ng\nh\ni"


@pytest.mark.parametrize("html", [None, "", " \n ", "<html></html>", "<nav>x</nav>", "<script>x", "<!--", "<", "<p", "</", "<!"])
def test_pages_without_text(html):
    assert page_text(html) == ""


def test_text_without_markup_and_cut_references():
    assert page_text("just  a text &amp") == "just a text &"
    assert page_text("<article><p>a &am</p></article>") == "a &am"


@pytest.mark.parametrize("html", ["<div>" * 60_000 + "x", "<p>" * 100_000 + "x", "</div>" * 100_000 + "x", "<a " * 50_000,
                                  "<!--" * 100_000, "<article>" * 30_000 + "x", "&" * 200_000, "<p class=ad>" * 50_000],
                         ids=range(8))
def test_hostile_pages_take_linear_time(html):
    assert page_text(html) in ("x", "", html)


def test_cluster_separates_text_from_menus():
    chars = np.array([5, 4, 6, 5, 200, 300, 12, 250, 5, 5, 4, 5], dtype=float)
    found = content_cluster(chars, np.full(12, 3.0))
    assert found[4:8].all() and not found[:3].any() and not found[10:].any()


def test_table_with_awkward_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.StringType()), T.StructField("lines", T.LongType())])
    good = f"<article>{BODY}</article>"
    long = "<article>" + BODY * 4000 + "</article>"
    rows = [(1, "u", good, "old", "x", 1), (1, "u", good, "old", "x", 1), (None, None, None, None, None, None),
            (2, "v", "", None, None, 2), (3, None, long, None, None, None)]
    found = with_main_text(spark.createDataFrame(rows, schema))
    assert found.columns == schema.fieldNames()
    got = sorted((r.page_id or 0, r.lines, r.text, r.n_chars) for r in found.collect())
    assert got[0] == (0, None, "", 0) and got[1] == got[2] == (1, 1, EXPECTED, len(EXPECTED)) and got[3] == (2, 2, "", 0)
    assert got[4][2] == "\n".join([EXPECTED] * 4000)
    empty = with_main_text(spark.createDataFrame([], schema))
    assert empty.count() == 0 and dict(empty.dtypes)["n_chars"] == "bigint"


def test_query_equals_the_articles_of_the_table(spark):
    def article(html):
        inner = re.search(r"<article>(.*?)</article>", html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", inner)
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
        return "\n".join(b for b in blocks if b)

    expected = {r["page_id"]: article(r["html"]) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    rows = catalog.QUERIES["op12_tag_ratio_main_text"](spark, SF)
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in rows.collect()}
    assert got == {k: (t, len(t)) for k, t in expected.items()}
    assert rows.where(F.col("url").isNull()).count() == 0
