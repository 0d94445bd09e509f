"""Url parts and rules against plain Python, reputation against its promises."""

import re

import pytest
from odd import rows
from pyspark.sql import functions as F

from partysieve.llm import host_reputation as h
from partysieve.llm.catalog import URL_RULES

URLS = [
    None, "", "no scheme/at.all", "http://", "https://Example.COM/en/x?q=/no#f", "https://www.example.com/en/", "https://x.www.example.com/en/1",
    "http://example.com/en", "http://myexample.com/en/x", "http://notcom/en", "ftp://a.net/es/?x", "http://a.net/es", "http://net/fr/", "http://A.NET?u=http://b.com/",
    "http://a.org#x://b.net/fr/", "see http://a.com/x://y", "http://ÄÖ.com/é", "//b.com/", "http://u@a.com:80/x", "http://1.2.3.4:8080/y", "http://a.co.uk/x\ny",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, k) for k, r in URL_RULES for n, p in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == n or host.endswith("." + n)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[4], "c"), (4, URLS[4], "c")],
                                  "page_id long, url string, host string")
    got = h.judge(pages, URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, kind = brute(URLS[4] if r["page_id"] is None else URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (kind or "allow")  # nothing is labelled
    assert h.judge(pages.where("false"), URL_RULES).collect() == []
    assert {r["rule"] for r in h.judge(pages, ()).collect()} == {None}


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "", "x.a.co.uk", "co.uk", "a.co:8080", "1.2.3.4:80", "a..b"]
    frame = spark.createDataFrame([(x,) for x in hosts], "host string")
    got = {r[0]: (r[1], r[2]) for r in frame.select("host", *h.domain_of(F.col("host"))).collect()}
    assert got == {"a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "": ("", ""),
                   "x.a.co.uk": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "a.co:8080": ("a.co", "co"),
                   "1.2.3.4:80": ("1.2.3.4", ""), "a..b": (".b", "b")}


def test_reputation_shrinks(spark):
    seen = [("bad.spam.com", 1)] * 40 + [("few.spam.com", 1)] * 2 + [("new.spam.com", None)] + [("good.fine.com", 0)] * 60
    seen += [("one.fine.com", 1)] + [("other.org", None)] + [(f"h{i}.site{i % 9}.net", int(i % 10 == 0)) for i in range(300)]
    got = {r["host"]: r for r in h.reputation(spark.createDataFrame(seen, "host string, bad int")).collect()}
    assert len(got) == 306
    assert got["bad.spam.com"]["bound"] > 0.5 > got["good.fine.com"]["mean"]
    assert got["new.spam.com"]["mean"] > got["other.org"]["mean"] > got["good.fine.com"]["mean"]
    assert got["one.fine.com"]["mean"] < 0.5 and got["other.org"]["bound"] < 0.5
    assert all(r["bound"] <= r["mean"] for r in got.values())
    pages = spark.createDataFrame([(1, "http://bad.spam.com/x"), (2, "http://good.fine.com/x"), (3, "http://unseen.xyz/")], "page_id long, url string")
    labelled = spark.createDataFrame([(f"http://{x}/p", b) for x, b in seen], "url string, bad int")
    got = {r["page_id"]: r["verdict"] for r in h.judge(pages, (), labelled=labelled).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}
    assert rows(h.judge(pages, (("allow", "bad.spam.com/"),), labelled=labelled))[0][4] == "allow"


@pytest.mark.parametrize("rules", [(("block", "a.com/x"), ("allow", "b.com/x")), (("block", "b.com/x"), ("allow", "b.com/x"))])
def test_ties(spark, rules):
    got = h.judge(spark.createDataFrame([(1, "http://b.com/xy")], "page_id long, url string"), rules).first()
    assert (got["rule"], got["verdict"]) == ("b.com/x", dict(map(reversed, rules))["b.com/x"] if len({r for _, r in rules}) == 2 else "block")


def test_hot_host(spark):
    """Half of all pages are of one host, and one domain has most hosts: each page has its host's verdict."""
    urls = [f"http://hot.big.com/{i}" for i in range(300)] + [f"http://h{i}.big.com/x" for i in range(200)] + [f"http://s{i}.org/x" for i in range(100)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(6)
    labelled = spark.createDataFrame([(u, 1) for u in urls[:120]] + [(u, 0) for u in urls[400:600]], "url string, bad int")
    got = h.judge(pages, (), labelled=labelled).collect()
    assert sorted(r["page_id"] for r in got) == list(range(600))
    known = {}
    for r in got:
        known.setdefault(r["host"], set()).add((r["verdict"], r["mean_ppm"], r["bound_ppm"]))
    assert len(known) == 301 and all(len(x) == 1 for x in known.values())
    assert [x[0] for x in known["hot.big.com"]] == ["block"] and {x[0] for k, v in known.items() if k.startswith("s") for x in v} == {"allow"}


def test_own_second_level(spark):
    frame = spark.createDataFrame([("a.b.gv.at",)], "host string")
    assert frame.select(*h.domain_of(F.col("host"))).first() == ("gv.at", "at")
    assert frame.select(*h.domain_of(F.col("host"), ("gv",))).first() == ("b.gv.at", "gv.at")
