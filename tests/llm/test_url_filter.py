"""URL filter: parsing and rules against brute force, the model on held-out urls."""

import re

import pytest

from tallyloom.llm import url_filter
from tallyloom.llm.queries import RULES, op3_url_filter


def parsed(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, path


def by_rule(host, path):
    fits = []
    for verdict, rule in RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def holds(row, url):
    host, path = parsed(url)
    assert (row["host"], row["path"]) == (host, path)
    rule, verdict = by_rule(host, path)
    assert row["rule"] == rule and row["verdict"] in ("allow", "block")
    assert verdict is None or row["verdict"] == verdict


def test_query_follows_the_rules(spark, sf):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op3_url_filter(spark, sf).collect()
    assert len(rows) == len(urls)
    for r in rows:
        holds(r, urls[r["page_id"]])


URLS = [None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://xcom/",
        "http://a.example.com/en/x", "http://www.EXAMPLE.com/en/", "http://b.www.example.com/en/",
        "http://example.com/en", "http://e.net/es/?q", "http://e.net?x=/fr/", "http://e.net#/fr/",
        "https://x.org/a://b.com/", "x://y\u00c4.NET/fr/\n?", "http://e.net/de/" + "a" * 20_000]


def test_awkward_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, path string")
    pages = pages.unionByName(pages.filter("page_id = 5"))
    rows = url_filter.judge(pages, RULES, url_filter.labelled_by_rules(pages, RULES)).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        holds(r, URLS[r["page_id"]])


def test_without_pages_or_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = url_filter.labelled_by_rules(pages, RULES)
    assert url_filter.judge(pages, RULES, none).first()["verdict"] == "allow"
    assert url_filter.judge(pages.limit(0), RULES, none).count() == 0
    allowed = none.union(spark.createDataFrame([("a", "/", "allow")], none.schema))
    assert url_filter.judge(pages, [], allowed).first()["p_block"] == 0.0


def test_model_learns_from_labels(spark):
    data = [(f"{'shop' if i % 2 else 'news'}{i}.org", f"/{'casino' if i % 2 else 'essay'}/{i}",
             "block" if i % 2 else "allow") for i in range(400)]
    labelled = spark.createDataFrame(data[:200], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(data[200:])],
                                  "page_id long, url string")
    got = url_filter.judge(pages, [], labelled).collect()
    right = sum(r["verdict"] == data[200 + r["page_id"]][2] for r in got)
    assert right >= 0.95 * len(got)
    again = url_filter.judge(pages, [], labelled.repartition(5)).collect()
    assert [pytest.approx(r["p_block"], abs=1e-9) for r in sorted(again)] == [
        r["p_block"] for r in sorted(got)]
