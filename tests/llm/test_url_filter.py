from __future__ import annotations

import fnmatch
import random
import re

from etafeat.llm import url_filter as op

PAGES = "page_id long, url string, html string"


def brute(url: str | None, rules=op.RULES) -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
        path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = []
    for i, (verdict, rule) in enumerate(rules):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), i, rule, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_against_brute_force(spark):
    random.seed(2)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.www.example.com", "xexample.com", "com", "net", "a.net", "b.org",
             "example.com.net", "é.com", "example.com:80", "u@example.com", "", "com.org", "a.net.b"]
    paths = ["", "/", "/en/", "/en", "/EN/", "/es/1", "/fr/", "/fr", "/en/x/com/", "//en/", "/x.com/en/", "/é/"]
    urls = [f"{s}://{h}{p}{q}" for s in ("http", "https") for h in hosts for p in paths for q in ("", "?a=/en/", "#://x.net/es/")]
    urls += [None, "", "no scheme", "http:/x", "://com/", "x://a.com/://b.net/es/", "http://example.com/en/" + "x" * 300_000]
    urls += random.choices(urls, k=200)
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op.judge(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_wildcards_and_many_words():
    rules = ["spam*.com/", "a?c.net/x*z", "*shop.org/", "b.io/*/ads/", *[f"site{i}.example.com/path/{i}/" for i in range(300)]]
    machine = op.Automaton(rules)
    assert machine.start.size > 20
    urls = ["spam.com/", "x.spam-farm.com/a", "spamfarm.com", "abc.net/x--z", "abbc.net/xz", "myshop.org/", "a/shop.org/", "b.io/p/q/ads/1",
            "b.io/ads/", "site7.example.com/path/7/x", "q.site299.example.com/path/299/", "site7.example.com/path/8/"]
    def plain(u):
        fits = []
        for i, r in enumerate(rules):
            h, _, p = r.partition("/")
            host, slash, path = u.partition("/")
            if slash and fnmatch.fnmatchcase("/" + path, "/" + p + "*") and any(fnmatch.fnmatchcase(host, x) for x in (h, "*." + h)):
                fits.append((len(r), i))
        return max(fits)[1] if fits else -1
    assert machine.match([u.encode() for u in urls]).tolist() == [plain(u) for u in urls]


def test_no_rows_and_no_rules(spark):
    assert op.judge(spark.createDataFrame([], PAGES)).collect() == []
    df = spark.createDataFrame([(1, "http://a.com/", None), (None, None, None)], PAGES).withColumnRenamed("html", "host")
    rows = op.judge(df, rules=(), default="block").collect()
    assert [(r.page_id, r.rule, r.verdict) for r in rows] == [(1, None, "block"), (None, None, "block")]
