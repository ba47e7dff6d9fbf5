import re

from immolens.llm.urls import DEFAULT_RULES, Rule, host_and_path, judge, ngrams
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, host string, rule string, label double, features string"


def pages(spark, urls):
    return spark.createDataFrame([(k, u, None, "h", "r", 1.0, None) for k, u in enumerate(urls)], SCHEMA)


def brute(url):
    """host, path, rule, verdict (None: left to the regression)."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "https://A.Example.COM/en/x?q=1#f", "http://www.example.com/en/", "http://xcom/en/",
        "http://www.example.com/de/", "http://b.www.example.com/en/1", "ftp://x.net/es/1", "http://x.net/fr", "http://x.net/fr/", "http://é.net/es/ü",
        "http://a.org/p", "http://a.org/p", "http://a.org?x=/en/", "a://b://c/d", "http://x.com#/y", "http://x.com:80/en/", "x" * 3000, "http://l.org/" + "p/" * 2000]


def test_hosts_paths_and_rules(spark):
    more = [f"http://s{k}.example.{t}/{l}/{k}" for k in range(30) for t in ("com", "net", "org") for l in ("en", "es", "fr")]
    urls = URLS + more
    rows = judge(pages(spark, urls)).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
        assert (r["block_probability"] is None) == (rule is not None)


def test_regression_carries_over_to_other_hosts(spark):
    rules = (Rule("block", "net/es/"), Rule("allow", "net/en/"))
    urls = [f"http://h{k}.net/{l}/{k}" for k in range(150) for l in ("es", "en")] + [f"http://h{k}.org/{l}/{k}" for k in range(40) for l in ("es", "en")]
    rows = judge(pages(spark, urls), rules).where("rule is null").collect()
    right = [r["verdict"] == ("block" if "/es/" in r["path"] else "allow") for r in rows]
    assert len(right) == 80 and sum(right) >= 78


def test_without_labels_and_with_one_class(spark):
    assert [r["verdict"] for r in judge(pages(spark, ["http://a.org/x", None])).collect()] == ["allow", "allow"]
    blocked = judge(pages(spark, ["http://a.net/es/1", "http://a.org/x"]), DEFAULT_RULES).collect()
    assert {r["verdict"] for r in blocked} == {"block"}
    assert judge(pages(spark, [])).count() == 0


def test_ngrams(spark):
    row = spark.createDataFrame([("ab",), ("",)], "s string").select(ngrams(F.col("s"), "h", (3,)).alias("g")).collect()
    assert [r["g"] for r in row] == [["h^ab", "hab$"], []]


def test_host_and_path_of_a_column(spark):
    host, path = host_and_path(F.lit("HTTP://Ab.C/D?e"))
    assert spark.range(1).select(host, path).first() == ("ab.c", "/D")
