import random

import pytest
from pyspark.sql import functions as F

from pricelake.llm import urls as U

from .conftest import rows_of

#: A list of sites, handed to the operator as any list is.
SITES = tuple(f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
              for top in ("com", "net", "org"))

URLS = [None, "", "no scheme", "http://", "http://example.com", "http://example.com/", "HTTP://WWW.Example.COM/en/x?q#f", "http://a.b.example.com/en/",
        "http://example.com/en", "http://example.com/EN/", "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://example.org/a?b=http://example.com/en/",
        "http://example.com:80/en/", "http://u@example.com/en/", "http://www.cheap-pills.example.com", "x://spam-farm.example.org/z", "http://com", "http://com/",
        "http://a..com/en/", "http://.com/", "x://y://example.com/en/", "http://example.com?/en/", "http://example.com#/en/", "http://WWW.EXAMPLE.COM/en/"]


def brute(url, rules, sites):
    _, sep, rest = (url or "").partition("://")
    host = path = ""
    if sep:
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = rest[:n], rest[n:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = tail[:next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]

    def fits(key):
        h, p = U.split_key(key)
        return bool(host) and (host == h or host.endswith("." + h)) and path.startswith(p)
    found = sorted(((len(k), v == "block", k, v) for v, k in rules if fits(k)))
    rule = found[-1][2] if found else None
    verdict = found[-1][3] if found else "block" if any(map(fits, sites)) else "allow"
    return host, path, rule, verdict


@pytest.mark.parametrize("class_keys", [10**6, 2])
def test_against_brute_force(spark, class_keys):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[5], None), (3, URLS[6], "h"), (3, URLS[6], "h")],
                                  "page_id long, url string, host string")
    got = U.filter_urls(pages, spark.createDataFrame(list(U.RULES), "verdict string, key string"),
                        spark.createDataFrame([(s,) for s in SITES], "key string"), class_keys=class_keys)
    rows = rows_of(got, "page_id")
    assert len(rows) == pages.count()
    for r in rows:
        url = URLS[5] if r["page_id"] is None else URLS[6] if r["page_id"] == 3 and r["host"] else URLS[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(url, U.RULES, SITES), url


def test_random_lists_are_exact(spark):
    r = random.Random(9)
    hosts = [".".join(r.choice("abc") for _ in range(r.randrange(1, 4))) for _ in range(60)]
    paths = ["/" + "".join(r.choice("xy/") for _ in range(r.randrange(4))) for _ in range(20)]
    rules = list({(r.choice(["allow", "block"]), r.choice(hosts) + r.choice(["", *paths])) for _ in range(120)})
    urls = [f"h://{r.choice(hosts)}{r.choice(['', *paths])}" for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = U.filter_urls(pages, spark.createDataFrame(rules, "verdict string, key string"), spark.createDataFrame([("c.a",)], "key string"))
    for x in rows_of(got, "page_id"):
        host, path, rule, verdict = brute(urls[x["page_id"]], rules, ["c.a"])
        assert (x["host"], x["path"], x["verdict"]) == (host, path, verdict)
        assert (x["rule"] or "").__len__() == len(rule or "")


def test_cascade_has_levels_and_is_exact(spark):
    marked = spark.range(4000).selectExpr("concat('k', id) AS key",
                                          "filter(array(if(id % 7 = 0, 'a', null), if(id < 3, 'b', null)), x -> x is not null) AS lists")
    c = U.build(marked, ["a", "b", "none"])
    assert len(c["a"]) > 1 and len(c["none"]) == 0
    assert [f"k{i}" in c["a"] for i in range(4000)] == [i % 7 == 0 for i in range(4000)]
    assert [i for i in range(4000) if f"k{i}" in c["b"]] == [0, 1, 2]


def test_empty_lists_and_pages(spark):
    rules = spark.createDataFrame([], "verdict string, key string")
    sites = spark.createDataFrame([], "key string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    (r,) = rows_of(U.filter_urls(pages, rules, sites), "page_id")
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == ("a.b", "/c", None, "allow")
    assert U.filter_urls(pages.limit(0), spark.createDataFrame(list(U.RULES), "verdict string, key string"), sites).count() == 0


def test_listed_sites_come_from_the_pages(spark):
    urls = ["http://shop.casino-win.example.com/a", "http://casino/x", "https://X.Ads.foo.bets.org/", "http://bets.org", "http://leads.org/",
            "http://a.b-ads-c.net:80/q?x", "http://cheap-pills.example.net", None, "no url", "http://", "http://.xxx.com/", "http://adsense.com/",
            "http://good.org/casino.html", "http://free-bets.io/", "http://www.free-bets.io/en/"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
    got = {r.key for r in U.marked_sites(pages).collect()}
    assert got == {"casino-win.example.com", "ads.foo.bets.org", "bets.org", "b-ads-c.net:80", "cheap-pills.example.net", "xxx.com", "free-bets.io"}
    rules = spark.createDataFrame([("allow", "example.com/")], "verdict string, key string")
    out = {r.page_id: (r.verdict, r.listed) for r in U.filter_urls(pages, rules, U.marked_sites(pages)).collect()}
    assert out[0] == ("allow", None) and out[2] == ("block", "ads.foo.bets.org") and out[3] == ("block", "bets.org")
    assert out[14] == ("block", "free-bets.io") and out[4] == out[11] == out[12] == ("allow", None)


def test_the_list_grows_with_the_hosts(spark):
    pages = spark.range(3000).select(F.concat(F.lit("http://h"), F.col("id"), F.lit("-spam.org/"), F.col("id") % 7).alias("url"), F.col("id").alias("page_id"))
    assert U.marked_sites(pages).count() == 3000
    none = spark.createDataFrame([], "verdict string, key string")
    assert U.filter_urls(pages, none, U.marked_sites(pages)).where("verdict = 'block' AND listed LIKE 'h%-spam.org'").count() == 3000
