import re

from tidegrid.llm import url_filter
from tidegrid.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com", "http://example.com/", "http://example.com/en",
    "http://example.com/en/", "https://a.b.net/es/1", "http://net/fr/", "http://b.net/fr", "x://y://com/en/", "http://xcom/", "http://notexample.com/en/",
    "http://www.example.com/en/?a", "http://www.example.com#/en/", "http://a.www.example.com/en/z", "http://.com/", "http://com./", "http://É.net/es/",
    "http://example.com:80/en/", "http://b.net/es/\n", "http://deep.er.a.b.c.d.net/fr/x/y", "http://www.example.com/en/" + "x" * 5000,
]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[3:] if fits else (None, "allow"))


def check(spark, rules, salts=3):
    pages = spark.createDataFrame([(i % 20, u, "x") for i, u in enumerate(URLS * 2)] + [(None, URLS[4], "x")], "page_id long, url string, rule string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.filter_urls(pages, frame, salts=salts).collect()), key=str)
    plain = [(h, p or "", v) for h, p, v in rules if h is not None]
    want = sorted(((r.page_id, *brute(r.url, plain)) for r in pages.collect()), key=str)
    assert got == want


def test_contract_rules(spark):
    check(spark, URL_RULES)


def test_nested_and_equal_rules(spark):
    rules = [
        ("com", "", "block"), ("com", "/en", "allow"), ("com", "/en/", "block"), ("com", "/en/", "allow"), ("example.com", "", "allow"),
        ("www.example.com", "/en/xxx", "block"), ("www.example.com", "/en/", "allow"), (None, "/", "block"), ("net", None, "block"), ("d.net", "/fr/x", "allow"),
    ]
    check(spark, rules)


def test_no_rules_and_no_pages(spark):
    check(spark, [])
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert url_filter.filter_urls(pages, rules).count() == 0
