"""URL rules against brute force; the query against its SQL is in tests/test_registry.py."""

import random
import re

from strata.llm.url_rules import RULES, judge_urls


def brute(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    fits = [(len(h) + len(p), len(h), v, h + p) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, default)


def test_brute_force(spark):
    r = random.Random(1)
    rules = [*RULES, ("block", "a.b.com", "/x"), ("allow", "b.com", "/xyz"), ("block", "co.uk", ""), ("block", "net", "/é/")]
    urls = [None, "", "example.com/en/", "http://", "http://com", "http://COM/", "https://Example.COM/en/1?x#y", "http://notexample.com/en/", "http://www.example.com/en/a", "x://a://b.net/es/", "http://a.b.com/xyz", "http://q.b.com/xyz?://net/fr/", "http://z.net/é/ü", "http://com./en/", "http://.com/", "http://a.co.uk", "http://u@example.com:80/en/", "http://example.com\n/en/", "http://" + "a." * 3000 + "com/", "http://net/" + "es/" * 5000]
    parts = ["http://", "https://", "www.", "a.", "b.", "example.", "com", "net", "/", "/en/", "/es/", "/fr/", "/x", "?", "#", "Q"]
    urls += ["".join(r.choice(parts) for _ in range(r.randrange(9))) for _ in range(500)]
    pages = spark.createDataFrame([*enumerate(urls), (3, urls[3]), (None, urls[6])], "page_id long, url string").selectExpr("page_id", "url", "'h' AS host", "'r' AS rule")
    got = sorted((tuple(x) for x in judge_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()), key=repr)
    want = sorted(((i, *brute(u, rules)) for i, u in [*enumerate(urls), (3, urls[3]), (None, urls[6])]), key=repr)
    assert got == want


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.net/es/")], "page_id long, url string")
    assert [tuple(x) for x in judge_urls(pages, none).collect()] == [(1, "a.net", "/es/", None, "allow")]
    assert judge_urls(pages.limit(0), none).collect() == []
