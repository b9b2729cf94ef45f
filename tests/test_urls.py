"""URL functions against the standard library."""

import ipaddress
from urllib import robotparser
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from seekloom.functions import urls
from seekloom.operators.frontier import link_edges
from seekloom.operators.robots import robots_rules, with_robots

URLS = [
    "https://a.example.org/x/y?z=1#f", "http://user:pw@h.example:8080", "HTTP://Up.Example/", "mailto:a@b", "//h/x",
    "ftp://f.example/a", "no url", "", "https://[::1]:80/x", "http://h?q", "http://h#f",
]


def column(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


def test_domain_and_base(spark):
    assert column(spark, URLS, urls.domain) == [urlparse(u).netloc for u in URLS]
    whole = [u for u in URLS if urlparse(u).netloc and urlparse(u).scheme]
    assert column(spark, whole, urls.base_url) == [f"{urlparse(u).scheme}://{urlparse(u).netloc}" for u in whole]


def test_resolve_link(spark):
    links = [
        "/a", "../a", "../../x?y=../z", "/a/../b", "/..", "/a/.", "/a/b/..", "//host/x/../y", "/a//b", "/a/./", "/x?", "/",
        "/a/b/../../../c", "../", "/a?b=/c/../d", "/a.b/..c/.d",
    ]
    base = "https://h.example:80"
    got = column(spark, links, lambda c: urls.resolve_link(F.lit(base), c))
    assert got == [urljoin(base, link) for link in links]
    assert column(spark, ["rel/x", "http://o/y"], lambda c: urls.resolve_link(F.lit(base), c)) == ["rel/x", "http://o/y"]


def test_edges(spark):
    hrefs = [
        "/abs", "../up", "//host/x", "rel", "#frag", "/x#frag", "mailto:a@b", "tel:1", "/f.pdf", "/f.PDF", "/f.pdf?x=1",
        "https://o.example/p", "/f.jpeg#a",
    ]
    pages = spark.createDataFrame([("https://h.example/d/e", hrefs)], "link string, hrefs array<string>")
    got = [(r["pos"], r["dst"]) for r in link_edges(pages).orderBy("pos").collect()]
    h = "https://h.example"
    assert got == [
        (0, f"{h}/abs"), (1, f"{h}/up"), (2, "https://host/x"), (5, f"{h}/x"), (9, f"{h}/f.PDF"), (10, f"{h}/f.pdf?x=1"),
        (11, "https://o.example/p"),
    ]


def test_predicates(spark):
    assert column(spark, ["http://x", "https://x", "ftp://x"], urls.has_http_scheme) == [True, True, False]
    assert column(spark, ["http://a/?u=google.com", "http://a"], urls.is_blocked) == [True, False]


def test_valid_ip(spark):
    addresses = [
        "1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "::1", "::", "2001:db8::1", "1::2::3", "1:2:3:4:5:6:7:8",
        "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "::ffff:1.2.3.4", "fe80::1%eth0", "12345::", "g::", "", "x", ":", ":::", "1:2:3:4:5:6:7::",
    ]

    def valid(address):
        try:
            ipaddress.ip_address(address)
            return True
        except ValueError:
            return False

    assert column(spark, addresses, urls.is_valid_ip) == [valid(a) for a in addresses]


def test_joins_of_values(spark):
    row = spark.range(1).select(
        urls.safe_join(F.lit("a"), F.lit(None), F.lit(3)).alias("j"), urls.safe_str(F.lit(None)).alias("s")
    ).first()
    assert (row["j"], row["s"]) == ("a 3", "")


ROBOTS = {
    "https://all.example": "User-agent: *\nDisallow:\n",
    "https://none.example": "User-agent: *\nDisallow: /",
    "https://order.example": "User-agent: *\nAllow: /a/b\nDisallow: /a # no\nDisallow: /c%20d\n",
    "https://other.example": "User-agent: bot\nDisallow: /\n\nUser-agent: x\nUser-agent: *\nCrawl-delay: 3\nDisallow: /q?x\n",
    "https://second.example": "User-agent: *\nDisallow: /1\n\nUser-agent: *\nDisallow: /2\n",
    "https://blank.example": "User-agent: *\n\nDisallow: /z\n",
    "https://late.example": "Disallow: /y\nUser-agent: *\r\nDisallow: /w\r\n\r\nDisallow: /v\r\nSitemap: https://late.example/s\r\n",
    "https://empty.example": "",
}
PATHS = ["", "/", "/a", "/a/b/c", "/a/x", "/c%20d", "/c d/e", "/q?x=1", "/q", "/1", "/2", "/z", "/y", "/w/1", "/v"]


def test_robots_like_the_standard_library(spark):
    rows = [(base + path,) for base in [*ROBOTS, "https://missing.example"] for path in PATHS]
    table = spark.createDataFrame(list(ROBOTS.items()), "base_url string, body string")
    found = with_robots(spark.createDataFrame(rows, "url string"), robots_rules(table))
    got = {r["url"]: r["allowed"] for r in found.collect()}
    for (url,) in rows:
        parser = robotparser.RobotFileParser()
        parser.parse(ROBOTS.get("/".join(url.split("/", 3)[:3]), "").splitlines())
        parser.modified()
        assert got[url] == parser.can_fetch("*", url), url
